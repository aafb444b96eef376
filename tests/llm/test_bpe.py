import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from vantage.llm import bpe, tokenbin
from vantage.llm.pieces import cut_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def odd_texts(n=400, seed=1):
    rng = random.Random(seed)
    parts = [" ", "  ", "   ", "\n", "\t", "\r\n", "a", "the", "'s", "'ll", "é", "e\u0301", "1", "23", "!", "...", "<|endoftext|>",
             "\u3000", "\x1c", "\x85", "\u2028", "漢字", "🙂", "ﷺ", "aaaa", "====", "x" * 70, "Z", "\u200b"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(n)]
    return texts + [None, "", " ", "  ", "a" * 4000, " lead", "trail ", "trail  ", "x  \ny", "\n \n"]


def test_encoding_and_decoding_equal_the_library(library):
    enc = bpe.Encoder(bpe.Vocabulary(PATH))
    texts = odd_texts()
    for _ in range(2):  # the second time from memory
        ids, ends = enc.encode(texts)
        back = enc.decode(ids, ends)
        for i, t in enumerate(texts):
            want = library.encode(t or "", add_special_tokens=False).ids
            assert ids[ends[i]:ends[i + 1]].tolist() == want, t
            assert back[i] == library.decode(want, skip_special_tokens=False)


def test_pair_check_agrees_with_exact_merging():
    v = bpe.Vocabulary(PATH)
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50000, 4000), rng.integers(0, 50000, 4000)
    a[:500] = b[:500] = rng.integers(0, 400, 500)  # equal neighbours
    fits = v.compatible(a, b)
    merged = v.exact([v.bytes_of[x] + v.bytes_of[y] for x, y in zip(a, b)])
    sure = v._sure(a) & v._sure(b)
    assert 100 < fits.sum() < 3900
    assert all(f == (m == [x, y]) for f, m, x, y, s in zip(fits, merged, a, b, sure) if s)


def test_only_failing_words_are_merged(monkeypatch):
    v = bpe.Vocabulary(PATH)
    v.encode_words([b" the", b" and"])
    asked = []
    plain = v.exact
    monkeypatch.setattr(v, "exact", lambda w: asked.append(list(w)) or plain(w))
    assert v.encode_words([b" the", b" and"]) == plain([b" the", b" and"])
    assert [w for a in asked for w in a] == []


def test_cuts():
    def cut(text, *specials):
        return cut_pieces(pa.array([text], pa.string()), specials)[0].to_pylist()

    assert cut("a b\nc d") == ["a", " b\nc", " d"] and cut("a  b") == ["a", " ", " b"]
    assert cut("a   b") == ["a", "  ", " b"] and cut("a \n b") == ["a", " \n", " b"]
    assert cut("a\n \nb") == ["a\n \nb"] and cut("a  ") == ["a", "  "] and cut("a\u3000 \u2003b") == ["a\u3000 \u2003b"]
    assert cut("it's, so.") == ["it", "'s", ",", " so", "."]
    assert cut("x <s>  y", "<s>") == ["x", " ", "<s>", " ", " y"] and cut("x  <s>", "<s>") == ["x", "  ", "<s>"]
    pieces, first = cut_pieces(pa.array(["a b", None, "", "c"]).slice(1, 3))
    assert pieces.to_pylist() == ["c"] and first.tolist() == [0, 0, 0, 1]


@pytest.mark.parametrize("limit", [1, 3000, 1 << 20])
def test_library_pieces_and_small_memos(library, limit):
    enc = tokenbin.LibraryEncoder(PATH)
    enc.memo.LIMIT = limit
    texts = odd_texts(300, 8) + [" ".join(f"w{i % 97},x{i}.\nY" for i in range(400))]
    for part in (texts[:150], texts[100:], texts):
        ids, ends = enc.encode(part)
        for i, t in enumerate(part):
            assert ids[ends[i]:ends[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, t
        kept = enc.memo.names.nbytes + 4 * len(enc.memo.ids)
        assert kept <= limit or not len(enc.memo.names)


def test_operator(spark, library):
    texts = odd_texts(60, 3)
    df = spark.createDataFrame([(i, t, [1], "d") for i, t in enumerate(texts)] + [(None, "a b", [1], "d"), (0, texts[0], [1], "d")],
                               "doc_id long, text string, ids array<int>, decoded string")
    got = bpe.digest_columns(bpe.bpe(df.repartition(3), PATH)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in [*enumerate(texts), (None, "a b"), (0, texts[0])]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.bpe(df.limit(0), PATH).collect() == []


def test_elias_fano():
    rng = np.random.default_rng(5)
    for values in ([], [0], [5], [7, 7, 7], list(range(1000)), np.sort(rng.integers(0, 10 ** 7, 3000)).tolist(),
                   np.sort(rng.integers(0, 50, 3000)).tolist(), [1, 2 ** 40]):
        v = np.array(values, np.int64)
        ef = tokenbin.EliasFano.build(v)
        assert ef.all().tolist() == values
        assert [ef.select(i) for i in range(len(v))] == values
        if len(v) == 3000:
            size = len(ef.low) + ef.high.nbytes + ef.samples.nbytes
            assert size < 3000 * (2.6 + max(0, np.log2(max(values) / 3000))) / 8 + 64


def test_token_files_round_trip(spark, library, tmp_path):
    texts = odd_texts(50, 9)
    rows = [((i * 37) % 101 - 20, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, start int, crc int")
    folder = f"file://{tmp_path}/tokens"
    got = tokenbin.token_files(df.repartition(4), PATH, folder=folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    by_id = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        by_id.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start and (r.n_tokens, r.crc) in by_id[r.doc_id]
        start += r.n_tokens
    for path in [r.path for r in spark.read.parquet(f"{folder}/manifest").collect()]:
        f = tokenbin.TokenFile(path)
        ends = f.ends.all().tolist()
        assert [f.span(i) for i in range(f.docs)] == list(zip([0, *ends], ends))
        assert f.kind.itemsize == 2 and all(f.ids(*f.span(i))[-1] == 0 for i in range(f.docs))
    assert tokenbin.token_files(df.limit(0), PATH).collect() == []


def test_parts_of_elias_fano():
    rng = np.random.default_rng(6)
    for v in (np.sort(rng.integers(0, 10 ** 6, 700)), np.sort(rng.integers(0, 50, 700)), np.array([1, 2 ** 40]), np.array([4])):
        ef = tokenbin.EliasFano.build(v)
        for _ in range(60):
            a, b = sorted(rng.integers(0, len(v) + 1, 2).tolist())
            assert ef.part(a, b).tolist() == v[a:b].tolist()
            assert ef.upto(int(v[a - 1]) if a else -1, a) == np.searchsorted(v, v[a - 1] if a else -1, "right")


def test_reader_decodes_only_the_boundaries_of_its_block(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts(300, 4))], "doc_id long, text string").coalesce(1)
    (listed, *_) = tokenbin.write_tokens(df, PATH, f"file://{tmp_path}/blocks").collect()
    f = tokenbin.TokenFile(listed.path)
    want = [x for b in tokenbin._documents(f, 7, 1 << 30) for x in b.to_pylist()]
    assert len(want) == f.docs and want[0]["start"] == 7 and [f.span(i)[0] + 7 for i in range(f.docs)] == [r["start"] for r in want]
    block, sizes, part = listed.ids // 9, [], tokenbin.EliasFano.part
    monkeypatch.setattr(tokenbin.EliasFano, "all", None)
    monkeypatch.setattr(tokenbin.EliasFano, "part", lambda self, a, b: sizes.append(b - a) or part(self, a, b))
    assert [x for b in tokenbin._documents(f, 7, block) for x in b.to_pylist()] == want
    assert sum(sizes) == f.docs and len(sizes) >= 9
