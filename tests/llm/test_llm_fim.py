"""Fill-in-the-middle against a plain version, and the wavelet matrix against counting."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrafold.llm import fim

UNIT_RE = {"line": r"[^\n]*\n|[^\n]+", "space": r"[^ \t\n\x0b\x0c\r]*[ \t\n\x0b\x0c\r]|[^ \t\n\x0b\x0c\r]+", "sentence": r"[^.!?]*[.!?]|[^.!?]+"}


def test_wavelet_matrix_counts_like_a_loop():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        codes = rng.integers(0, 8, size, dtype=np.uint8)
        m = fim.WaveletMatrix(codes)
        at = np.arange(size + 1)
        for c in range(8):
            assert m.rank(c, at).tolist() == [int((codes[:i] == c).sum()) for i in at]
        if size:
            start, end = rng.integers(0, size, 50), None
            end = np.minimum(start + rng.integers(0, 200, 50), size)
            k = rng.integers(0, 12, 50)
            got = m.after((1, 3), start, end, k)
            for s, e, n, g in zip(start, end, k, got):
                assert g == next((i for i in range(s, e + 1) if np.isin(codes[s:i], (1, 3)).sum() >= n), e)


def plain(doc_id, text, unit, percent, spm):
    text = text or ""
    u = re.findall(UNIT_RE[unit], text)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if text == "" or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= percent:
        return (doc_id, len(u), "plain", None, None, text)
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    return (doc_id, len(u), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")


@pytest.mark.parametrize("unit,percent", [("line", 100), ("space", 70), ("sentence", 100)])
def test_forms_cuts_and_round_trip(spark, unit, percent):
    rng = random.Random(3)
    alphabet = ["a", "é", "漢", "😀", "\n", "\n", " ", ".", "\r", "\t", "<P", ">", "<S", "7", "\\E"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(120)]
    texts += [None, "", "\n", "\n\n\n", "x", "no end\nof line", "has <M> inside\nhere\n", "z\n" * 70000, "é" * 300000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, "a\nb\nc"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, n int")
    got = fim.fill_in_middle(df, unit=unit, percent=percent)
    back = got.withColumn("back", fim.restored())
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    want = sorted((plain(i, t, unit, percent, 50) for i, t in rows), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    texts_back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["back"]) for r in back.collect())
    assert texts_back == sorted((i is None, i or 0, t or "") for i, t in rows)
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_blocks_cut_like_one(spark):
    text = pa.array(["a\nb\nc", "", "é\n\n", "x" * 10])
    h = np.array([3, 5, 7, 11]), np.array([2, 9, 1, 4])
    whole = fim.cuts(text, *h)
    for i in range(4):
        one = fim.cuts(text.slice(i, 1), h[0][i : i + 1], h[1][i : i + 1])
        assert [int(x[0]) for x in one] == [int(x[i]) for x in whole]


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")), unit="token")
