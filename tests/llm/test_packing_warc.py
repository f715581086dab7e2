import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from molspark.llm import packing, warc
from molspark.llm.queries import tokenizer_path

ODD = [None, "", " ", "  two  spaces   three ", "\n\n a\n b \t c", "it's  they've", "é ñ 日本 😀 a😀b", "x<|endoftext|>y", "hello <|endoftext|> world",
       "<|endoftext|>", "<|endoftext|><|endoftext|> a.", "<|endoftext|", "a <|endoftext|>\n", "a" * 3000,
       "12 345,6.", "A. B! C? d", " nb  sp ", "long. " * 30_000, "nostop" * 4000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_units_give_the_tokenizers_ids(tokenizer):
    r = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(r.choice(["the", " ", "  ", "\n", " a", ".", "'s", "é", "\t", "Zq", "<|endoftext|>"]) for _ in range(60))
                                      for _ in range(300)]
    for most in (10, 1_000_000):  # also when the memory starts anew all the time
        units = packing.Units(tokenizer_path(), most)
        for at in range(0, len(texts), 7):
            part = texts[at:at + 7]
            for t, (ids, _) in zip(part, units.encode(part)):
                assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def cost(ends, price, p):
    total, begin = 0.0, 0
    for e in ends:
        n = e - begin
        assert 0 < n <= p.length
        power = n >= p.least_power and n & (n - 1) == 0
        total += (0 if power else p.length - n) + price.get(e, p.inner_cost)
        begin = e
    return total


def test_cuts_are_the_cheapest(spark):
    r = random.Random(3)
    p = packing.Params(length=16, least_power=4, sentence_cost=1, inner_cost=3)
    for _ in range(200):
        n = r.randint(1, 90)
        cuts = sorted(r.sample(range(1, n + 1), r.randint(0, n // 2)))
        price = {c: r.choice([0.0, 1.0]) for c in cuts} | {n: 0.0}
        ends = packing.best_cuts(n, np.array(cuts, np.int64), np.array([price[c] for c in cuts]), p)
        assert ends[-1] == n
        # The same cuts by the plain quadratic programme.
        points = sorted(set(cuts) | {n} | {c + 16 for c in [0, *cuts] if c + 16 <= n})
        full = sorted(set(points) | {x for a, b in zip([0, *points], points) for x in range(a, b, 16) if x > a})
        best = {0: 0.0}
        for b in full:
            best[b] = min((best[a] + (0 if (b - a) >= 4 and (b - a) & (b - a - 1) == 0 else 16 - (b - a)) for a in best if 0 < b - a <= 16),
                          default=float("inf")) + price.get(b, 3)
        assert cost(ends, price, p) == pytest.approx(best[n])


def checked(rows, docs, tokenizer, length=1024):
    """Every id in one piece, sequences gapless and not too long; returns padding's share."""
    want = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[k])
            assert r.ids_crc32 == zlib.crc32(np.array(want[k][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want[k])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / max(1, sum(map(len, want.values())))


def test_pieces(spark, tokenizer):
    docs = list(enumerate(ODD))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    checked(packing.pack(df, tokenizer_path()).collect(), docs, tokenizer)
    small = packing.pack(df, tokenizer_path(), params=packing.Params(buffer=4096))
    checked(small.collect(), docs, tokenizer)


def test_pieces_of_the_table(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert checked(packing.pack(df, tokenizer_path()).collect(), docs, tokenizer) < 0.02


def test_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([("k", "a b", 1), ("k", "a b", 2), (None, None, 3)], "doc_id string, text string, start int").coalesce(1)
    rows = packing.pack(df, tokenizer_path()).collect()
    assert sorted((r.doc_id or "", r.start, r.length, r.offset) for r in rows) == [("", 0, 1, 6), ("k", 0, 3, 0), ("k", 0, 3, 3)]
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0


# --- WARC --------------------------------------------------------------------

PAGES = [None, "", "x" * 99, "x" * 100, "é" * 50, "é" * 49, "a\r\n\r\nWARC/1.1\r\n\r\nb" * 40, "big é" * 40_000, "\r\n\r\n" * 60, " lead", "tail\r\n"]


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", h, 1) for i, h in enumerate(PAGES + PAGES)] + [(500, None, "null url", 1), (501, "bad\r\nurl", "u", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(4)
    warc.write_warc(df, str(tmp_path / "w"), segment_bytes=1000, chunk_bytes=300)
    records = warc.read_records(spark, str(tmp_path / "w"))
    assert records.where("type = 'continuation'").count() > 100
    got = {r.page_id: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, url, h, _ in rows:
        body = (h or "").encode()
        first.setdefault(body, i)
        r = got[i]
        again = len(body) >= 100 and first[body] != i
        assert r.problem is None and r.payload_bytes == len(body) and r.payload_digest == hashlib.sha256(body).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", first[body]) if again else ("response", None))
        assert again or bytes(r.payload) == body


def test_null_and_repeated_ids(spark, tmp_path):
    same = "payload " * 20
    df = spark.createDataFrame([(None, "u", same), (3, "u", same), (3, "u", same), (4, "u", same)], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"))
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_warc(spark, str(tmp_path / "w")).collect())
    assert got == [(0, "revisit", 3), (3, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_broken_segments(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc " * 2000), (2, "u", "def " * 2000), (3, "u", "ghi " * 2000)], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"), segment_bytes=1000)
    records = warc.read_records(spark, str(tmp_path / "w"))
    origin = {r.page_id: r.record_id for r in records.where("segment = 1").collect()}
    gap = records.where(f"NOT (origin = '{origin[1]}' AND segment = 3)").where(f"NOT (origin = '{origin[2]}' AND total IS NOT NULL)")
    got = {r.page_id: (r.problem, r.block is None) for r in warc.reassemble(gap).collect()}
    assert got == {1: ("a segment is missing or doubled", True), 2: ("the last segment is missing", True), 3: (None, False)}


def test_framing():
    for body in (b"", b"x", b"ab\r\n0\r\n\r\n" * 50):
        assert warc.dechunked(warc.chunked(body, 7)) == body
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)
