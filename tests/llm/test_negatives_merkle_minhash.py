"""Hard negatives, Merkle manifest and one-permutation near duplicates against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from authlane.llm import hard_negatives as H
from authlane.llm import merkle as M
from authlane.llm import minhash as X
from authlane.llm.minhash import MinHash, Sketcher, minhash_duplicates
from authlane.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle_manifest"])
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = QUERIES[name](spark, SF)
    rel = db.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r)) for r in found.select(*names).collect())


# Hard negatives


@pytest.mark.parametrize("largest, width", [(3, 1), (300, 64), (2**15, 300), (2**24, 700)])
def test_scores_are_exact(largest, width):
    draw = np.random.default_rng(5)
    a, b = (draw.integers(-largest, largest + 1, (n, width)) for n in (7, 9))
    a[0], b[0], b[1] = largest, largest, -largest
    expected = a.astype(object) @ b.T.astype(object)
    primes = H.primes_for(int(abs(expected).max()))
    assert (H.exact_scores(H.residues(a.astype(float), primes), H.residues(b.astype(float), primes), primes) == expected).all()


def mined(rows, scale=256, k=5):
    """By the definition, over (vec_id, label, vector) in Python integers."""
    ok = [
        (i, v, l, [math.floor(scale * x) for x in e]) for i, (v, l, e) in enumerate(rows)
        if l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    found = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for i, v, label, e in ok:
        if v is None or v % 100:
            continue
        scored = [(sum(x * y for x, y in zip(e, f)), w, m) for j, w, m, f in ok if j != i]
        positives = sorted((s for s in scored if s[2] == label), key=order)[:k]
        for ps, p, _ in positives:
            inside = sorted((s for s in scored if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:k]
            found += [(v, p, n, s[1], ps, s[0]) for n, s in enumerate(inside, 1)]
    return sorted(found, key=str)


def test_odd_vectors_against_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, draw.randrange(4), [draw.choice([-0.4, 0.1, 0.25, 0.5]) for _ in range(6)]) for i in range(420)]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, [1.0] * 6), (600, 1, None), (700, 1, [nan] * 6), (701, 1, [inf, 0.0]), (702, 2, [None, 0.5])]
    rows += [(800, 1, []), (801, 1, [0.5]), (900, 2, [0.5] * 6), (900, 2, [0.5] * 6), (None, 2, [0.5] * 6), (None, 1, [0.5] * 5), (-100, 3, [0.5] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    table = table.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double")))
    exact = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    clashing = table.select("*", *[F.lit("x").alias(c) for c in ("row", "v", "cell", "kind", "goals", "score", "rank", "anchor")])
    for mining in (H.Mining(), H.Mining(pack=60, batch=3)):  # one pack, and many
        found = H.hard_negatives(clashing, F.col("vec_id") % 100 == 0, mining)
        assert sorted((tuple(r) for r in found.collect()), key=str) == mined(exact)
    assert found.columns == list(H.RESULT)


def test_no_anchors_no_rows_and_too_large(spark):
    table = spark.createDataFrame([(1, 1, [1e30])], "vec_id long, label int, embedding array<double>")
    assert H.hard_negatives(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert H.hard_negatives(table, F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(ValueError, match="64-bit"):
        H.hard_negatives(table, F.lit(True))


# Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    shown = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*shown)


def climb(nodes):
    """The root, and per leaf its steps (comes first, sibling)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            j = i ^ 1
            paths[leaf].append((j < i, nodes[j] if j < len(nodes) else None))
            at[leaf] = i // 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def manifest_of(rows, tampered):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    roots, trees = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        root, paths = climb([leaf_of(*r) for r in own])
        roots.append(root)
        trees.append((own, paths, root))
    top, top_paths = climb(roots)
    found = []
    for (own, paths, root), above in zip(trees, top_paths):
        for r, path in zip(own, paths):
            path = path + above
            up = leaf_of(*r)
            changed = leaf_of(*r[:3], r[3] + 1, r[4]) if tampered(r) and r[3] is not None else up
            fold = changed
            for first, other in path:
                fold = digest(*([other] if first else []), fold, *([] if first or other is None else [other]))
            proof = digest(*[o for _, o in path if o is not None])
            found.append((r[0], up, root, top, proof, fold))
    return sorted(found, key=str)


def merkle_rows(sizes):
    rows = [(1000 * k + i, "s", lang, None if i % 5 == 4 else i, f"text é {i}") for k, (lang, n) in enumerate(sizes) for i in range(n)]
    return rows + [(doc_id, None, None, 3, text) for doc_id, text, *_ in ODD]


@pytest.mark.parametrize("sizes", [[("en", 1)], [("en", 2), ("de", 3), ("", 16), ("ünï", 17)], [("en", 300), ("fr", 33), ("aa", 256)]])
def test_manifest_equals_brute_force(spark, sizes):
    rows = merkle_rows(sizes)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("tree", "size", "rank", "level", "lo", "digest", "row", "leaf", "path")])
    crc = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    marked = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    found = M.tampered_manifest(docs, marked).select(
        "doc_id", *[M.as_text(F.col(c)) for c in ("leaf", "subroot", "root")], M.proof_digest(F.col("path")), M.as_text(F.col("folded_root"))
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == manifest_of(rows, crc)


def test_manifest_of_nothing(odd):
    assert M.manifest(odd.limit(0)).count() == 0


def test_very_long_text_and_siblings_from_intervals(spark, docs_of):
    found = M.manifest(docs_of("x" * 3_000_000, "y", "z")).collect()
    first = next(r for r in found if r.doc_id == 0)
    assert first.leaf.hex() == leaf_of(0, "s", "en", 3_000_000, "x" * 3_000_000)
    assert [s.left for s in first.path] == [False, False] and first.path[0].sibling == next(r.leaf for r in found if r.doc_id == 1)


# One-permutation near duplicates


def shingle_set(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def linked_components(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        ((doc_id, len(s), least.get(find(i)) if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))), key=str
    )


def found_components(docs, sim=MinHash()):
    found = minhash_duplicates(docs, sim).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


def family(n, seed, words=120, edits=14):
    """A text, copies with some words replaced, copies of copies, and beginnings of it."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(words)]
    texts = [base]
    for _ in range(n - 1):
        t = list(draw.choice(texts[-3:]) if draw.random() < 0.3 else base)
        for _ in range(draw.randrange(edits)):
            t[draw.randrange(len(t))] = f"x{draw.randrange(5000)}"
        texts.append(t[: draw.randrange(words // 2, words + 1)] if draw.random() < 0.2 else t)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_equal_brute_force(docs_of, seed):
    rows = list(enumerate(family(220, seed) + ["one two three", "ONE two  three", "one two three four five", ""]))
    assert found_components(docs_of(*rows)) == linked_components(rows)


def test_odd_documents(clashing):
    rows = [(r[0], r[1]) for r in ODD]
    assert found_components(clashing) == linked_components(rows)
    assert minhash_duplicates(clashing.limit(0)).count() == 0


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_components(docs) == linked_components(rows)


def test_pairs_grow_with_the_family_not_its_square(docs_of, monkeypatch):
    compared = []
    add = X.Tried.add

    def counting(self, found):
        rows = add(self, found)
        compared[-1] += rows.count()
        return rows

    monkeypatch.setattr(X.Tried, "add", counting)
    for n in (150, 600):
        compared.append(0)
        minhash_duplicates(docs_of(*family(n, 4))).count()
    assert compared[1] < 8 * compared[0] and compared[1] < 600 * 599 / 8


def test_bins_agree_as_often_as_sets(spark):
    """Densified bins of small sets too: the share of equal bins is the similarity."""
    draw = np.random.default_rng(8)
    sketcher = Sketcher(MinHash())
    for size, shared in ((12, 9), (40, 30), (400, 300)):
        seen = []
        for _ in range(60):
            pool = np.unique(draw.integers(0, 2**64, 2 * size - shared, dtype=np.uint64))
            order = draw.permutation(pool)
            a, b = np.sort(order[:size]), np.sort(np.concatenate([order[:shared], order[size:]]))
            seen.append(np.mean(sketcher.bin_values(a) == sketcher.bin_values(b)))
        assert abs(np.mean(seen) - shared / (2 * size - shared)) < 0.06
