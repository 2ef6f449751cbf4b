"""Large groups of near copies, whose texts repeat runs of words."""

import random

import brute
import pytest

from tarnlake.llm import prob_minhash
from tarnlake.llm.prob_minhash import near_duplicates

REFRAIN = "as it was said before so it is said again to all who hear".split()


def song(copies, changes, seed, verses=3):
    """Copies of one text with refrains; each has a number of its words replaced."""
    rng = random.Random(seed)
    base = []
    for verse in range(verses):
        base += [f"w{verse}x{i}" for i in range(22)] + REFRAIN * 2
    rows = []
    for doc in range(copies):
        words = list(base)
        for place in rng.sample(range(len(words)), rng.choice(changes)):
            words[place] = f"c{rng.randrange(10**9)}"
        rows.append((doc, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_of_texts_with_refrains_match_all_pairs(spark, seed):
    rows = song(24, (1, 2, 3, 4, 6), seed) + [(100 + i, t) for i, t in song(8, (3, 4, 8), seed + 10)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == brute.near_classes(rows)


def compared_pairs(spark, monkeypatch, rows):
    counts = []
    verified = prob_minhash._verified

    def counting(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(prob_minhash, "_verified", counting)
        near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    return sum(counts)


def test_a_pair_is_met_once_however_many_rare_runs_it_shares(spark, monkeypatch):
    counts = []
    met = prob_minhash._met

    def counting(*how):
        pairs = met(*how)
        counts.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(prob_minhash, "_met", counting)
    near_duplicates(spark.createDataFrame(song(30, (3, 5, 7), 5), "doc_id long, text string"))
    [(rows, pairs)] = counts
    assert rows == pairs > 0


@pytest.mark.xfail(reason="open: pairs just under 0.8 are met one by one, 1,031 of 60 copies and 13,414 of 240")
def test_pairs_follow_the_size_of_a_group(spark, monkeypatch):
    small, large = (compared_pairs(spark, monkeypatch, song(n, (3, 5, 7), 5, 6)) for n in (60, 240))
    assert small > 0
    assert large <= 6 * small


def test_texts_of_one_refrain_and_own_words_are_not_met_one_by_one(spark, monkeypatch):
    """Each is about 0.7 to each other: a fifth of its runs, the rarest, are its own."""
    own = {doc: " ".join(f"own{doc}x{i}" for i in range(36)) for doc in range(40)}
    rows = [(doc, " ".join([own[doc], *REFRAIN * 16])) for doc in own]
    rows += [(100 + doc, f"{rows[doc][1]} end") for doc in (3, 7)]
    counts = []
    met = prob_minhash._met

    def counting(*how):
        pairs = met(*how)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(prob_minhash, "_met", counting)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == brute.near_classes(rows)
    assert sum(counts) <= len(rows)


@pytest.mark.parametrize("seed", range(5))
def test_own_shares_bound_the_similarity(seed):
    rng = random.Random(seed)
    for _ in range(200):
        one, other = ({e: rng.choice((1, 2, 9, 40)) for e in range(12) if rng.random() < 0.8} | {tag: 1} for tag in "ab")
        shared = one.keys() & other.keys()
        a, b = (1 - sum(x[e] for e in shared) / sum(x.values()) for x in (one, other))
        exact = sum(1 / sum(max(one.get(j, 0) / one[e], other.get(j, 0) / other[e]) for j in {*one, *other}) for e in shared)
        assert exact <= (1 - a) * (1 - b) / (1 - a * b) + 1e-9
