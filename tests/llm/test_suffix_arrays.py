"""Repeated strings against counting every window."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlweft.llm import suffix_arrays as sa


def some_bytes(rng, n, letters=b"ab"):
    return bytes(rng.choice(letters) for _ in range(n))


def expected(texts, length):
    """(n_bytes, spans, kept) of each text."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        hit = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if counts[r[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        edges = [k for k in range(len(r) + 1) if (hit[k - 1] if k else 0) != (hit[k] if k < len(r) else 0)]
        out.append((len(r), list(zip(edges[::2], edges[1::2], strict=True)), bytes(b for b, h in zip(r, hit, strict=True) if not h)))
    return out


def found(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], [tuple(x) for x in r["spans"]], bytes(r["kept"])) for r in df.collect())


def want(rows, length):
    return sorted((str(i), *x) for (i, _), x in zip(rows, expected([t for _, t in rows], length), strict=True))


@pytest.mark.parametrize("seed", range(4))
def test_block_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        segments = [some_bytes(rng, rng.randrange(1, 40), rng.choice([b"ab", b"\x00\x01", b"abcdefgh\xc3\xf4"])) for _ in range(rng.randrange(1, 9))]
        length = rng.randrange(1, 20)
        code, suffixes, ranks = sa.suffix_array(segments)
        # Separators sort by place, before all bytes.
        tails, at = [], 0
        for k, s in enumerate(segments):
            tails += [(tuple(b + 1000 for b in s[i:]) + (k,), at + i) for i in range(len(s) + 1)]
            at += len(s) + 1
        tails.sort()
        assert suffixes.tolist() == [i for _, i in tails]
        common = [0] + [next(n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y) for (a, _), (b, _) in zip(tails, tails[1:], strict=False)]
        assert sa.common_prefixes(code, suffixes, ranks, length).tolist() == [min(c, length) for c in common]
        counts = Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
        repeated = [[i for i in range(len(s) - length + 1) if counts[s[i : i + length]] > 1] for s in segments]
        assert [x.tolist() for x in sa.repeated_starts(segments, length)] == repeated


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    spans = sa._spans(20)
    keys = {}
    for raw in [some_bytes(rng, n) for n in (19, 20, 21, 300, 5000)] + [b"a" * 7000, b"abc" * 900]:
        for gram in (4, 12, 20):
            start, size, key, inner = sa.segments_of(raw, gram, 20, spans)
            windows = [a + i for a, s in zip(start.tolist(), size.tolist(), strict=True) for i in range(s - 19)]
            assert windows == list(range(len(raw) - 19))
            assert not len(size) or size.max() <= 20 - gram + 20 or gram == 20
            for a, s, k, again in zip(start.tolist(), size.tolist(), key.tolist(), inner.tolist(), strict=True):
                for i in range(a, a + s - 19):  # equal windows have equal keys
                    assert keys.setdefault((gram, raw[i : i + 20]), k) == k
                if len({raw[i : i + 20] for i in range(a, a + s - 19)}) < s - 19:
                    assert again or gram == 20


def corpus(rng):
    """Shared passages, near copies, copies, periodic texts and a line that many texts hold."""
    words = [some_bytes(rng, rng.randrange(2, 7), b"abcdeXYZ").decode() for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = prose(12), "é common line that many hold"
    texts = [prose(rng.randrange(3, 60)) for _ in range(40)]
    texts += [prose(5) + passage + prose(7) for _ in range(12)]
    texts += [prose(4) + line + prose(4) for _ in range(60)]
    long = prose(80)
    for _ in range(15):
        at = rng.randrange(len(long))
        texts.append(long[:at] + rng.choice("xyz") + long[at + 1 :])
    texts += [long] * 6 + ["short"] * 5 + [None, None, "", "", "b" * 3000, "ab" * 40, "b" * 41, "ünï" * 30]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(3, "a repeated id " * 2), (3, None), (None, passage)]


@pytest.mark.parametrize(
    ("length", "grams", "key_bytes", "block"),
    [
        (40, (10, 20, 32), 1 << 18, 1 << 20),
        (40, (10, 20, 32), 300, 500),  # most keys are hot and go deeper
        (40, (10,), 1, 1),  # down to whole windows
        (9, (4, 6), 400, 2000),
    ],
)
def test_cut_repeats(spark, length, grams, key_bytes, block):
    rows = corpus(random.Random(length))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).withColumns({"tid": F.lit(1), "n": F.lit("x"), "key": F.lit(2)})
    assert found(sa.cut_repeats(df, length=length, grams=grams, key_bytes=key_bytes, block=block)) == want(rows, length)


def test_empty_table(spark):
    assert sa.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(1, None), (2, ""), (3, "short")]
    assert found(sa.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == want(rows, sa.LENGTH)


def test_query_with_very_long_texts(spark, tmp_path):
    """Production parameters: texts beyond one stretch of hashing, with passages over its borders."""
    from crawlweft.llm.queries import op12_suffix_array

    rng = random.Random(9)
    prose = lambda n: "".join(rng.choices("abcdefgh é.", k=n))
    long, passage = prose(1_200_000), prose(700)
    border = (1 << 20) - sa.LENGTH
    cut = len(long.encode()[: border - 300].decode(errors="ignore"))
    rows = [(1, long), (2, prose(500) + long[cut : cut + 900] + prose(300)), (3, prose(900) + passage + prose(10)), (4, passage + prose(2000)), (5, prose(399)), (6, "aB" * 300), (7, None)]
    rows += [(k, prose(50) + passage[: 399 if passage[:399].isascii() else 390] + prose(60)) for k in range(10, 14)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_suffix_array(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    plain = expected([t for _, t in rows], sa.LENGTH)
    assert got == {i: (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for (i, _), (n, spans, kept) in zip(rows, plain, strict=True)}
    assert got[2][1] >= 900
    assert got[6][1] == 600
