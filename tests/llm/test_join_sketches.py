"""Groups of the near-duplicate join are parted by sketches before sets are sent."""

import random

import numpy as np
import pytest

from rollbook.llm import ngram_join
from tests.llm.test_join_pack_encode import classes


def tokens(rng, n):
    return np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))


def alike(rng, base, gone, more):
    return np.unique(np.concatenate((rng.permutation(base)[gone:], tokens(rng, more))))


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_part_no_link(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 40), 63, 64, 255, 256, 300, 1000, 5000]:
        base = tokens(rng, n)
        sets = [base, *[alike(rng, base, rng.integers(0, n // 3 + 1), rng.integers(0, n // 4 + 1)) for _ in range(12)]]
        sets = [s for s in sets if len(s)]
        sizes = np.array([len(s) for s in sets])
        label = ngram_join.may_link(ngram_join.fold([ngram_join.sketch(s, percent) for s in sets]), sizes, percent)
        side = np.arange(len(sets)) % 2
        across = ngram_join.may_link(ngram_join.fold([ngram_join.sketch(s, percent) for s in sets]), sizes, percent, side)
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    assert label[a] == label[b]
                    assert across[a] == across[b] or side[a] == side[b]


def test_half_alike_sets_are_parted():
    rng = np.random.default_rng(5)
    base = tokens(rng, 1000)
    sets = [alike(rng, base, 300, 300) for _ in range(50)]
    sets += [alike(rng, s, 20, 20) for s in sets[:10]]
    label = ngram_join.may_link(ngram_join.fold([ngram_join.sketch(s, 80) for s in sets]), np.array([len(s) for s in sets]), 80)
    assert len(set(label.tolist())) == 50
    assert (label[50:] == label[:10]).all()


@pytest.mark.parametrize("block", [2_000_000, 5000, 300])
def test_only_sets_that_may_link_are_sent(spark, monkeypatch, block):
    """All texts meet on one signature at least, but few are alike enough."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(60):
        at = rng.randrange(300)
        rows.append(" ".join(base[:at] + [f"x{rng.random()}" for _ in range(100)] + base[at + 100 :]))
    rows += [t + f" tail{k}" for k, t in enumerate(rows[:7])]
    rows = list(enumerate(rows))
    monkeypatch.setattr(ngram_join, "signatures", lambda tokens, percent: np.array([7], dtype=np.uint64))
    sent, solve = [], ngram_join._classes_of_groups
    monkeypatch.setattr(ngram_join, "_classes_of_groups", lambda texts, dealt, *how: sent.append(dealt.count()) or solve(texts, dealt, *how))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.linked_classes(docs, percent=80, block_tokens=block)
    assert sorted(map(tuple, got.collect()), key=repr) == classes(rows, 80)
    assert len({c for _, _, c in classes(rows, 80)}) == 60
    assert sent[0] < 40
