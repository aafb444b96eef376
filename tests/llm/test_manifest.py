"""Feistel shards and Merkle manifests against plain versions."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vantage.llm.merkle import merkle_manifest, proof_digest
from vantage.llm.sharding import Permutation, row_of, shard_rows, write_shards

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 100, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = Permutation(n, seed=3)
    places = p.of(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert p.back(places).tolist() == list(range(n))


def test_permutation_depends_on_the_seed_and_mixes():
    a, b = Permutation(10_000, 1).of(np.arange(10_000)), Permutation(10_000, 2).of(np.arange(10_000))
    assert (a != b).mean() > 0.99
    assert abs(np.corrcoef(np.arange(10_000), a)[0, 1]) < 0.05
    assert Permutation(10_000, 1).of(np.arange(10_000)).tolist() == a.tolist()


def shards(spark, rows, n=8, seed=0):
    df = spark.createDataFrame(rows, DOCS + ", shard string, `carry` string, pos int")
    return shard_rows(df, n, {"doc_id": F.col("doc_id"), "text": F.col("text")}, seed=seed).collect()


def test_shards_are_even_gapless_computable_and_keep_all_rows(spark):
    rows = [(i, f"t{i % 5}", None, "s", 1, "x", "y", 0) for i in range(101)]
    rows += [(7, "t2", None, "s", 1, "x", "y", 0)] * 30 + [(None, None, None, None, None, None, None, None)] * 3
    got = shards(spark, rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in got) == \
        sorted((r[0] is not None, r[0] or 0, r[1] or "") for r in rows)
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(8)]
    assert all(x == list(range(len(x))) for x in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert sorted(r.row for r in got) == list(range(len(rows)))
    assert all(row_of(r.shard, r.slot, len(rows), 8) == r.row for r in got)
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.row)]
    assert ids == [None] * 3 + sorted(x for x in ids if x is not None)
    again = shards(spark, rows[::-1])
    assert sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in again) == \
        sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in got)


def test_shards_of_few_and_no_rows(spark):
    assert shards(spark, []) == []
    assert len({r.shard for r in shards(spark, [(i, "", None, None, 0, "", "", 0) for i in range(3)])}) == 3


def test_written_shards_hold_whole_rows_in_the_order_of_slots(spark, tmp_path):
    df = spark.createDataFrame([(i, "w " * i, "en", None, i) for i in range(60)], DOCS)
    table = write_shards(df, str(tmp_path / "shards"), 4)
    got = table.collect()
    assert {(r.doc_id, r.text, r.lang, r.n_chars) for r in got} == {(i, "w " * i, "en", i) for i in range(60)}
    for s in range(4):
        slots = [r.slot for r in table.where(f"shard = {s}").orderBy("slot").collect()]
        assert slots == list(range(15))
    with pytest.raises(ValueError):
        write_shards(df.withColumn("Slot", F.lit(1)), str(tmp_path / "other"), 4)


ALL = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & ALL
    x = (x ^ x >> 29) * 0x94D049BB133111EB & ALL
    return x ^ x >> 32


def plain_place(x, n, seed=0):
    """The permutation with plain integers, one number at a time."""
    a = math.isqrt(max(n - 1, 0)) + 1
    b = -(-n // a)
    key = plain_mix(seed + 0x5EED)
    keys = [plain_mix(k * 0x9E3779B97F4A7C15 & ALL ^ key) for k in range(1, 9)]
    while True:
        left, right = divmod(x, b)
        for k, own in enumerate(keys):
            if k % 2:
                left = (left + plain_mix(right + own & ALL) % a) % a
            else:
                right = (right + plain_mix(left + own & ALL) % b) % b
        x = left * b + right
        if x < n:
            return x


def test_registered_shards_equal_a_plain_version(spark):
    from vantage.llm.queries import op11_feistel_shards
    folder = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    want = []
    for row, (i, text) in enumerate(docs):
        data = (text or "").encode()
        place = plain_place(row, len(docs))
        want.append((i, len(data) + 1, zlib.crc32(data), "rows", place % 8, place // 8, None, row))
    assert sorted(map(tuple, op11_feistel_shards(spark, folder).collect())) == want


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row) -> str:
    doc_id, text, lang, source, n = row[:5]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    out = []
    for level in tree[:-1]:
        a = at // 16 * 16
        out.append((level[a:at], level[at + 1:a + 16]))
        at //= 16
    return out


def plain(rows, tampered) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault("" if r[3] is None else "=" + r[3], []).append(r)
    trees, places = [], []
    for g in sorted(groups, key=str.encode):
        put = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in put]))
        places.append(put)
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (tree, put) in enumerate(zip(trees, places)):
        for i, r in enumerate(put):
            path = siblings(tree, i) + siblings(top, k)
            acc = leaf((r[0], r[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])) \
                if tampered(r) else leaf(r)
            for before, after in path:
                acc = sha("".join(before) + acc + "".join(after))
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], sha("".join("".join(b + a) for b, a in path)), acc))
    return out


def low(name, c):
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if name == "text" else c


@pytest.mark.parametrize("case", ["odd", "large group", "many groups", "lone"])
def test_manifest_equals_the_plain_tree(spark, case):
    rows = {
        "odd": [(1, "Ab", "en", "s", 2), (1, "Ab", "en", "s", 2), (1, "ä", None, "s", None), (None, None, None, None, None),
                (None, "X", "", None, 1), (3, "", "", "", 0), (4, "Z" * 50_000, "en", "é", 5), (5, "q", "en", "z", 1)]
        + [(100 + i, f"Text {i}", "en", "s", i) for i in range(17)],
        "large group": [(i, f"T{i}", "en", "big" if i % 10 else f"s{i % 3}", i) for i in range(4700)],
        "many groups": [(i, f"T{i}", "en", f"s{i % 300}", i) for i in range(900)],
        "lone": [(9, "One", "en", "s", 3)],
    }[case]
    df = spark.createDataFrame([(*r, "x", 1, "p") for r in rows], DOCS + ", g string, pos int, path string").repartition(5)
    hit = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    got = merkle_manifest(df, FIELDS, tampered=hit, tamper=low)
    got = got.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof"),
                     F.element_at("copied", -1).alias("folded"), "copied", "path", "altered").collect()
    want = plain(rows, lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
    key = lambda r: tuple(str(x) for x in r[:6])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert all(len(r.copied) == len(r.path) + 1 for r in got)
    assert all(r.folded == r.root for r in got if r.altered in (None, r.leaf))
    assert all(r.folded != r.root for r in got if r.altered not in (None, r.leaf))


def test_manifest_of_an_empty_table(spark):
    got = merkle_manifest(spark.createDataFrame([], DOCS), FIELDS)
    assert got.collect() == [] and got.columns[:4] == ["doc_id", "leaf", "subroot", "root"]
