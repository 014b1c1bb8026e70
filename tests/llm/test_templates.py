"""Documents of one template that nearly link: what the n-gram join pairs, and that its components stay exact."""

import random

import pytest

from recordloom.llm import ngram_join

from .test_llm import join_by_hand


def of_a_template(seed, n, edits, length=200):
    """Each text has some words of the template replaced, from few, so hardly any n-gram stands in one text alone."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for k in range(n):
        said = list(base)
        for _ in range(edits if isinstance(edits, int) else rng.choice(edits)):
            said[rng.randrange(length)] = f"v{rng.randrange(3)}"
        out.append((k, " ".join(said)))
    return out


@pytest.fixture
def paired(monkeypatch):
    """Numbers of pairs that were verified, turn by turn."""
    seen, real = [], ngram_join._verified

    def count(pairs, *rest):
        seen.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_verified", count)
    return seen


@pytest.mark.parametrize("link", [ngram_join.Link(4, 85, 100), ngram_join.Link(5, 80, 100)])
def test_components_of_a_template(spark, link):
    """Some link, some do not, some only through others."""
    rows = of_a_template(3, 150, (1, 2, 3, 4, 6, 9))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), link).collect())
    assert got == join_by_hand(rows, link)
    assert 3 < len({c for _, _, c in got}) < 150


def with_slots(seed, n, slots, values, length=200):
    """One text with a few slots, each filled with one of some words: most pairs just fail to link, and all share frequent n-grams."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        said = [f"w{j}" for j in range(length)]
        for slot in range(slots):
            said[length * (slot + 1) // (slots + 1)] = f"v{slot}x{rng.randrange(values)}"
        out.append((k, " ".join(said)))
    return out


def test_pairs_grow_with_the_texts(spark, paired):
    """Without sketches the last turn pairs four times as many for twice the texts, 12 % of all pairs."""
    totals = []
    for n in (250, 500):
        paired.clear()
        rows = with_slots(1, n, 6, 20)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == join_by_hand(rows, ngram_join.Link())
        assert len(paired) < 3 or paired[2] < 0.02 * n * (n - 1) / 2
        totals.append(sum(paired))
    assert totals[1] < 2.8 * totals[0]
