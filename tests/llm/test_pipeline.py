"""The stages, each judged on its own input."""

from __future__ import annotations

from itertools import combinations

import corpus_pipeline as P
import numpy as np

from authlane.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    docs = table(spark, SF, "documents")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == list(P.COLUMNS)
        before, after = ({r.doc_id for r in d.select("doc_id").collect()} for d in (docs, out))
        assert after <= before
        if name != "mixing sources to target weights":
            assert len(after) > 0.8 * len(before)
        docs = out
    assert out.where("n_chars <> char_length(text)").count() == 0


def test_run(spark):
    found = P.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 0


def test_clean_and_wordless_documents_stay(spark, docs_of):
    docs = docs_of("", None, "  ", "one two three four five", "one two three four five", "another text of some words")
    kept = {r.doc_id for r in P.near_dedup(spark, docs, SF).collect()}
    assert kept == {0, 1, 2, 3, 5}


def _first_of_near(texts):
    """Ids that are the least of their group: five-word shingles, Jaccard similarity of 0.8 and more."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    first = {i: i for i in texts}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in links:
            first[a] = first[b] = min(first[a], first[b])
    return {i for i in texts if first[i] == i}


def test_near_dedup_against_all_pairs(spark, docs_of):
    rng = np.random.default_rng(5)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 30, n)]
    rows = []
    for n in (40, 100, 250):
        for part in (0.10, 0.17, 0.19, 0.22, 0.24, 0.26, 0.30):
            base = words(n)
            more = words(round(n * part))
            rows += [" ".join(base), " ".join(base + more), " ".join(base[len(more) :])]
    kept = {r.doc_id for r in P.near_dedup(spark, docs_of(*rows), SF).collect()}
    assert kept == _first_of_near(dict(enumerate(rows)))
    docs = table(spark, SF, "documents")
    kept = {r.doc_id for r in P.near_dedup(spark, docs, SF).collect()}
    assert kept == _first_of_near({r.doc_id: r.text for r in docs.collect()})


UNIQUE = "words that no other text of the table has in it"


def test_near_dedup_judges_rows_not_ids(docs_of):
    copy = "one two three four five six seven"
    docs = docs_of((1, copy), (2, copy), (2, UNIQUE), (None, copy), (3, UNIQUE + " x y z"), (3, UNIQUE + " x y z"))
    kept = sorted((r.doc_id, r.text) for r in docs_rows(docs))
    assert kept == [(1, copy), (2, UNIQUE), (3, UNIQUE + " x y z")]


def test_near_dedup_without_ids_and_of_odd_rows(spark, docs_of, clashing, odd):
    copy = "one two three four five six seven"
    assert [(r.doc_id, r.text) for r in docs_rows(docs_of((None, copy), (None, copy), (None, "")))].count((None, copy)) == 1
    kept = P.near_dedup(spark, clashing, SF)
    assert kept.columns == list(P.COLUMNS)
    # The copies 7, 7 and 8 are one group; documents without words stay.
    found = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert found == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert kept.where("doc_id IS NULL").count() == 1
    assert docs_rows(odd.limit(0)) == []


def docs_rows(docs):
    return P.near_dedup(docs.sparkSession, docs, SF).collect()


def test_line_dedup_stage_of_odd_rows(spark, clashing, odd):
    kept = {r.doc_id: r.text for r in P.line_dedup(spark, clashing, SF).collect()}
    assert kept[0] is None and kept[1] == "" and kept[2] == " \t\n"
    assert (kept[5], kept[6]) == ("Same line here\nown 5", "own 6")
    # Document 8 had one line, which 7 holds: nothing is left of it. Repeats of 7 are one document.
    assert 8 not in kept and None in kept
    assert P.line_dedup(spark, odd.limit(0), SF).count() == 0


def test_mixing_and_packing_stages_of_odd_rows(spark, clashing, odd):
    mixed = P.mixing(spark, clashing, SF)
    assert mixed.columns == list(P.COLUMNS)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in odd.collect()}
    assert P.mixing(spark, odd.limit(0), SF).count() == 0
    packed = P.packing(spark, clashing, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in odd.collect()}
    assert P.packing(spark, odd.limit(0), SF).count() == 0
