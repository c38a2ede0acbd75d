"""The audit of sources against exact arithmetic in plain Python, on awkward rows, and chunk by chunk."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from meshloom.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, n string, groups int, kept int"


def slow(rows, least):
    docs = [(lang or "", source or "", [t for t in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if "a" <= c <= "z" or c >= "\x80" else " " for c in text or "").split(" ") if t]) for _, text, lang, source, *_ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted((t for t, n in df.items() if n >= least), key=str.encode)
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= least) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + int(Fraction(10**9 * (c[t] + 5), sum(c.values()) + 5 * len(kept)))
        for s, c in count.items():
            pairs = sorted(((sum(abs(share(c, t) - share(o, t)) for t in kept), x) for x, o in count.items() if x != s), key=lambda r: (-r[0], r[1].encode()))
            out |= {(lang, s, "pair", x, v, k) for k, (v, x) in enumerate(pairs, 1)}
            terms = sorted(((share(c, t) - share(whole, t), t) for t in kept if c[t]), key=lambda r: (-r[0], r[1].encode()))
            out |= {(lang, s, "term", t, v, k) for k, (v, t) in enumerate(terms, 1) if v > 0 and k <= 50}
    return out


def rows():
    r = random.Random(5)
    words = ["".join(r.choices("abcdeßé漢", k=r.randint(1, 3))) for _ in range(150)] + ["Straße", "STRASSE", "ÄÖ", "äö", "\U0001f600", "￮"]
    out = [(k, " 1_".join(r.choices(words, k=r.randint(0, 60))), r.choice(["en", "de", None]), r.choice(["a", "b", "c", "ä", None, ""]), "x", 1, 2) for k in range(160)]
    return out + [(7, None, "en", "only null", "", 0, 0), (7, "", "xx", "s", "", 0, 0), (None, "rare", "xx", "t", "", 0, 0), (9, "a " * 50000, "en", "long", "", 0, 0)] + [(11, "same words here", "en", "b", "", 0, 0)] * 6


@pytest.mark.parametrize("chunk", [1024, 7])
def test_audit_equals_exact_arithmetic(spark, monkeypatch, chunk):
    monkeypatch.setattr(divergence, "_BLOCK", 2 if chunk == 7 else 128)
    monkeypatch.setattr(divergence, "_STEP", 1000)
    counts = divergence.count_terms(spark.createDataFrame([], "lang string, source string, b binary"))
    assert counts.columns == ["lang", "source", "term", "n", "df"]
    made = rows()
    got = [tuple(r) for r in divergence.audit(spark.createDataFrame(made, DOCS).repartition(3), least=5).collect()]
    assert len(got) == len(set(got)) and set(got) == slow(made, 5)


def test_audit_of_no_rows_and_of_rows_without_terms(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []
    bare = [(1, None, None, None, "", 0, 0), (2, "12 3", None, "b", "", 0, 0), (3, "x", "fr", "a", "", 0, 0)]
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(bare, DOCS)).collect()} == {("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)}


def test_chunks_end_at_terms_and_sum_up(spark):
    """Chunks cut at any term, with sources compared in blocks of any size, add up to the whole."""
    r = np.random.default_rng(1)
    names, width = [f"s{k}" for k in range(9)], 40
    cells = r.permutation(9 * width)[:150]
    s, ids, n = cells // width, cells % width, r.integers(1, 1 << 45, 150)
    totals = np.bincount(s, weights=n, minlength=9).astype(np.int64)
    totals[:] = [sum(int(x) for x, k in zip(n, s, strict=True) if k == g) for g in range(9)]

    def compare(keep):
        at = {k: i for i, k in enumerate(keep)}
        rows = [(int(a), at[int(b)], int(c)) for a, b, c in zip(s, ids, n, strict=True) if b in at]
        chunk = {"terms": keep, "names": names, "s": [x[0] for x in rows], "id": [x[1] for x in rows], "n": [x[2] for x in rows]}
        return Counter({(i, j): v for part, i, j, _, v in divergence.compare_chunk(names, totals.tolist(), width, chunk) if part == "pair"})

    whole, parts = compare(list(range(width))), compare(list(range(13))) + compare(list(range(13, width)))
    assert whole == parts and len(whole) == 36


def test_shares_are_exact_for_very_large_counts():
    count = np.array([0, 1, 10**15, 3 * 10**15, 9 * 10**17], np.int64)
    for whole in (9 * 10**15, 10**18 + 7):
        assert divergence.shares(count[count < whole - 5], np.full((count < whole - 5).sum(), whole)).tolist() == [1 + 10**9 * (int(c) + 5) // whole for c in count if c < whole - 5]
