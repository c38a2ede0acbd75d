"""Passages of words against brute force: overlaps, copies, ids that repeat, crowded keys, references of their own."""

import hashlib
import random
import re

import numpy as np
import pytest

from meshloom.llm import passages
from meshloom.llm.automaton import SuffixAutomaton

DOCS = "doc_id long, text string, lang string, k string, first int, least long, t long"
WORDS = [f"w{k}" for k in range(60)]


def slow(docs, reference=None):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in docs]
    held = {}
    for i, words in split if reference is None else [(None, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in reference]:
        for a in range(len(words) - 49):
            w = tuple(words[a : a + 50])
            held[w] = i if reference is not None else min(held.get(w, i), i) if i is not None else held.get(w, float("inf"))
    out = []
    for i, words in split:
        gone = set()
        for a in range(len(words) - 49):
            w = tuple(words[a : a + 50])
            if w in held and (reference is not None or i is not None and held[w] < i):
                gone.update(range(a, a + 50))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def made(seed=3):
    r = random.Random(seed)
    prose = lambda n: " ".join(r.choices(WORDS, k=n))
    hot, base = prose(70), prose(300)
    mixed = base.split()
    mixed[150] = "changed"
    out = [
        (1, base), (2, base), (3, " ".join(mixed)), (4, None), (5, ""), (6, " \t\n\v\f\r"), (7, "one"), (7, "one"), (None, base), (8, "\n".join(base.split())), (9, prose(49)), (10, base[: len(base) // 2]),
        (11, hot + " x " + hot), (12, " ".join(hot.split()[5:56])), (13, " ".join(hot.split()[:49])), (13, hot), (13, hot), (14, "a " * 400), (15, "b " + "a " * 60), (16, "É é 漢字 x \x00 " * 30), (17, "É é 漢字 x \x00 " * 12), (-5, " ".join(hot.split()[10:65])),
    ]
    out += [(100 + k, f"{prose(r.randint(0, 40))} {hot} {prose(r.randint(0, 60))}") for k in range(40)]
    out += [(200 + k, " ".join(prose(20) if x else " ".join(base.split()[(s := r.randint(0, 240)) : s + r.randint(45, 60)]) for x in (0, 1, 0, 1))) for k in range(20)]
    r.shuffle(out)
    return [(i, t, "en", "k", 1, 2, 3) for i, t in out]


def got(df):
    return sorted((tuple(x) for x in df.select("doc_id", "n_words", "n_removed", "kept_sha256", "text").collect()), key=str)


@pytest.mark.parametrize(("crowded", "shard", "step"), [(1 << 17, 1 << 16, 1 << 22), (2000, 500, 700), (150, 100, 64)])
def test_passages_equal_brute_force(spark, monkeypatch, crowded, shard, step):
    monkeypatch.setattr(passages, "CROWDED", crowded)
    docs = made()
    rows = spark.createDataFrame(docs, DOCS).repartition(4)
    monkeypatch.setattr(passages, "_SHARD", shard)
    monkeypatch.setattr(passages, "_STEP", step)
    found = got(passages.drop_passages(rows, keep_text=True))
    assert found == slow(docs) and sum(r[2] for r in found) > 3000


@pytest.mark.parametrize("most", [1 << 18, 10])
def test_known_passages_of_a_reference(spark, monkeypatch, most):
    monkeypatch.setattr(passages, "BROADCAST_WORDS", most)
    docs, texts = made(4), [None, "", "few words", *[t for _, t, *_ in made(4)[:30:3]], "a " * 70]
    reference = spark.createDataFrame([(t, "x") for t in texts], "text string, b string")
    found = got(passages.drop_known(spark.createDataFrame(docs, DOCS), reference, keep_text=True))
    assert found == slow(docs, texts)
    assert passages.drop_known(spark.createDataFrame(docs, DOCS), reference.limit(0)).agg({"n_removed": "sum"}).first()[0] == 0


def test_passages_of_empty_tables_and_rows_without_values(spark):
    assert passages.drop_passages(spark.createDataFrame([], DOCS)).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in passages.drop_passages(spark.createDataFrame([(None,) * 7] * 2, DOCS)).collect()] == [(None, 0, 0, empty)] * 2


def test_pieces_of_equal_windows_have_equal_keys():
    """Whatever surrounds a window, its segment and the pieces of every width get the same key."""
    r = np.random.default_rng(2)
    window = r.integers(0, 1 << 63, 50).astype(np.uint64)
    for width in passages.LEVELS:
        keys = set()
        for before in range(40):
            words = np.concatenate([r.integers(0, 1 << 63, before).astype(np.uint64), window, r.integers(0, 1 << 63, 30).astype(np.uint64)])
            f, n, k, _ = next(s for s in passages.segments(words) if s[0] <= before < s[0] + s[1])
            cut = passages.pieces(words[f : f + n + 49], k, width)
            assert sum(p[1] for p in cut) == n and all(p[1] <= width for p in cut)
            keys.add((k, next(p[2] for p in cut if p[0] <= before - f < p[0] + p[1])))
        assert len(keys) == 1


def test_matching_statistics_equal_brute_force():
    r = random.Random(8)
    for letters in (1, 2, 4):
        held = [[r.randrange(letters) for _ in range(r.randint(0, 30))] for _ in range(8)]
        automaton, texts = SuffixAutomaton(), ["-".join(map(str, h)) for h in held]
        for h in held:
            automaton.add(h)
        assert len(automaton.size) <= 2 * sum(map(len, held)) + 1
        text = [r.randrange(letters + 1) for _ in range(200)]
        inside = lambda a, e: any(f"-{'-'.join(map(str, text[a:e]))}-" in f"-{t}-" for t in texts)  # noqa: E731, B023
        want = [max([e - a for a in range(max(e - 9, 0), e) if inside(a, e)], default=0) for e in range(1, 201)]
        assert automaton.statistics(text, 9) == want


@pytest.mark.parametrize("step", [1, 13, 1 << 22])
def test_texts_are_split_piece_by_piece(monkeypatch, step):
    monkeypatch.setattr(passages, "_STEP", step)
    text = " a bb\tccc  dddd\n\né 漢字\x00 x \r\n".encode() * 9
    words = text.split()
    assert [w for part in passages.word_lists(text) for w in part] == words
    first, end = passages.word_places(text)
    assert [text[a:e] for a, e in zip(first, end, strict=True)] == words
    ranges = [{"first": a, "end": e} for a, e in [(0, 3), (2, 5), (5, 6), (10, 30), (12, 20), (50, 63)]]
    kept = [w for k, w in enumerate(words) if not any(r["first"] <= k < r["end"] for r in ranges)]
    n, removed, digest, rest = passages._kept(text, ranges)
    assert (n, removed, rest) == (len(words), len(words) - len(kept), b" ".join(kept)) and digest == hashlib.sha256(rest).hexdigest()
