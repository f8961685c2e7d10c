"""The source divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from terrafold.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value long, chunk int"


def plain(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        ws = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(ws)
        docs[lang].update(set(ws))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        share = {}
        for s in [*sources, None]:
            c = counts[lang, s] if s is not None else sum((counts[lang, x] for x in sources), Counter())
            total = sum(c[t] for t in kept) + len(kept)
            share[s] = {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pair = sorted((-sum(f(share[s][t], share[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            term = sorted((-f(share[s][t], share[None][t]), t.encode()) for t in kept if counts[lang, s][t] and share[s][t] > share[None][t])[:top]
            out += [(lang, s, part, i.decode(), -v, r + 1) for part, got in (("pair", pair), ("term", term)) for r, (v, i) in enumerate(got)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 1, 2, 3) for i, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("sources,chunk,block,words", [(3, 2048, 32, 1 << 20), (9, 7, 2, 64)])
def test_audit_matches_plain_counting(spark, monkeypatch, sources, chunk, block, words):
    monkeypatch.setattr(divergence, "CHUNK_TERMS", chunk)
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", block)
    monkeypatch.setattr(divergence, "AND_WORDS", words)
    rng = random.Random(sources)
    vocab = ["Alpha", "alpha", "Ünit", "ünit", "東京", "don't", "x1y", "b_c", "İ", "Z", "é́"] + ["w" + chr(97 + i // 9) + chr(97 + i % 9) for i in range(60)]
    rows = []
    for i in range(150):
        k = min(int(rng.expovariate(0.05)), len(vocab))
        rows.append((" ".join(rng.choice(vocab[: k + 1]) for _ in range(rng.randrange(0, 40))), rng.choice(["en", "de"]), f"s{min(int(rng.expovariate(0.4)), sources - 1)}"))
    rows += [rows[0]] * 3 + [(None, "en", "silent"), ("", None, None), ("12 34 --", "xx", "a"), ("one two", "xx", "b"), ("only here", "zz", None), (("hot " * 90000), "en", "s0"), (None, None, "t")]
    assert sorted(tuple(r) for r in divergence.audit(made(spark, rows), top=5).collect()) == plain(rows, 3, 5)


def test_empty_table_and_one_document(spark):
    assert divergence.audit(made(spark, []).limit(0)).count() == 0
    assert divergence.audit(made(spark, [("a b", "en", "s")])).count() == 0


def test_terms_end_with_their_text():
    found, row = divergence.terms(pa.array(["ab", "cd ef", "", "1", "é!É"]))
    assert found.to_pylist() == ["ab", "cd", "ef", "é", "É"] and row.tolist() == [0, 1, 1, 4, 4]
