"""Near copies by similarity, against all pairs compared."""

import random
import re
from itertools import combinations

import pytest
from helpers import classes, frame, messy, sentence

from snapledger.llm import near_copies, simhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def similar(docs):
    """All pairs of ids whose shingles have a similarity of 0.8 or more."""
    sets = {i: shingles(t) for i, t in docs.items()}
    return [(a, b) for a, b in combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]


def edited(rng, text, share):
    words = text.split()
    return " ".join(f"w{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def groups(docs, table):
    found = {r.node: r.component for r in near_copies.similar_groups(table).collect()}
    return {i: found.get(i, i) for i in docs}


@pytest.mark.parametrize("tree,group", [(4096, 1024), (5, 4)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, tree, group):
    """Messy rows, and copies with a growing share of changed words; also with groups cut to chunks."""
    monkeypatch.setattr(near_copies, "TREE", tree)
    monkeypatch.setattr(near_copies, "GROUP", group)
    rng = random.Random(4)
    rows, _ = messy(spark)
    for k in range(40):
        base = sentence(rng, rng.randint(60, 400))
        rows += [(10_000 + 10 * k + j, edited(rng, base, s)) for j, s in enumerate([0, 0.01, 0.02, 0.03, 0.05, 0.1])]
        rows += [(10_000 + 10 * k + 9, base.upper())]
    docs = dict(rows)
    want = classes(docs, similar(docs))
    assert groups(docs, frame(spark, rows)) == want
    assert len({want[i] for i in docs if i >= 10_000}) > 60  # copies that are too unlike stay apart


def test_the_stage_keeps_one_of_each_group(spark):
    rng = random.Random(8)
    base = sentence(rng, 300)
    rows = [(5, base), (3, edited(rng, base, 0.015)), (9, sentence(rng, 300)), (7, None), (8, ""), (11, "two words")]
    docs = frame(spark, rows)
    kept = simhash.without_near_copies(docs, find=near_copies.near_copy_groups)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9, 11]


def test_repeated_and_missing_ids_and_an_empty_table(spark):
    rng = random.Random(9)
    base, other = sentence(rng, 200), sentence(rng, 200)
    docs = frame(spark, [(4, base), (4, other), (None, base + " end"), (None, None), (6, base)])
    kept = simhash.without_near_copies(docs, find=near_copies.near_copy_groups)
    assert sorted((str(r.doc_id), str(r.text)[:20]) for r in kept.collect()) == sorted([("4", base[:20]), ("4", other[:20]), ("None", "None")])
    assert near_copies.similar_groups(docs.filter("false")).collect() == []
    assert near_copies.near_copy_groups(docs.filter("false")).collect() == []
