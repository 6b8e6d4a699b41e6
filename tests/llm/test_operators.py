"""Each operator against a brute-force version, a law it must keep, or held-out rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import numpy as np
import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F

from authlane.llm import queries as Q
from authlane.llm import common, minhash
from authlane.llm import components as parts
from authlane.llm import jaccard_join as joined
from authlane.llm.common import table, written
from authlane.llm.components import components
from authlane.llm import fingerprints as prints
from authlane.llm.fingerprints import fingerprints
from authlane.llm.jaccard_join import Similarity, near_duplicates
from authlane.llm.line_dedup import bare_line, dedup_lines, line_key, surplus_lines
from authlane.llm.mixing import mixed_documents, source_targets
from authlane.llm.packing import byte_bpe_50k, encode, shortest_pack_first
from authlane.llm.sharding import ShardTree, shard_documents
from authlane.llm.wand_search import Search, search

SF = "/root/testdata/sf0.001"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_against_sql(spark, name):
    assert mismatch(Q.QUERIES[name](spark, SF), connect(SF), Q.ORACLES[name]) is None


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in Q.QUERIES}
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_declared_language_is_found(spark):
    found = Q.op1_language_id(spark, SF).toPandas()
    assert (found.lang == found.declared).mean() > 0.98


def test_line_dedup_at_a_higher_threshold(docs_of):
    docs = docs_of("shared line one\nx", "shared line one\nshared line two", "Shared Line One \nshared line two")
    kept = {r.doc_id: r.text for r in dedup_lines(docs, min_docs=3).collect()}
    assert kept == {0: "shared line one\nx", 1: "shared line two", 2: "shared line two"}


def test_line_dedup_counts_lines_and_carries_a_text_once(docs_of):
    rows = [(0, None), (1, ""), (2, "\n"), (3, "shared line one\n\nb\n"), (4, "shared line one"), (None, "shared line one\nq"), (3, "shared line one")]
    docs = docs_of(*rows)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    want = [(0, None, 1, 0), (1, "", 1, 0), (2, "\n", 2, 0), (3, "shared line one\n\nb\n", 4, 0), (4, "", 1, 1), (None, "shared line one\nq", 2, 0), (3, "shared line one", 1, 0)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(got, key=order) == sorted(want, key=order)
    # Nothing but the text itself and the hashes of its lines goes into the join.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    carried = [x for x in plan.splitlines() if "AS row#" in x]
    assert len(carried) == 1 and "text, " not in carried[0].split("AS row#")[0]


def test_line_keys_lose_ascii_case_and_white_space_alone(spark, docs_of):
    lines = [" \t Ab\x0b", "ÄB C\r", "\u00a0Ab ", "İI", "", " \x0c", "\x1fA", "Σ AZ[`"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select("line", line_key(bare_line(F.col("line"))).alias("key"))
    want = {x: re.sub("[A-Z]", lambda c: c[0].lower(), x.strip(" \t\n\x0b\x0c\r")) for x in lines}
    assert {r.line: r.key for r in rows.collect()} == want


def test_line_dedup_trims_a_line_once(docs_of):
    plan = surplus_lines(docs_of("shared line one"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 2  # once for the holders, and once for the positions


def test_near_duplicates_looks_beyond_the_tokens_a_set_must_look_up():
    for percent in range(50, 100):
        assert Similarity(percent=percent).looked_at >= 1.04 - percent / 100
    assert Similarity(percent=85).looked_at == 0.2


@pytest.mark.parametrize("n", [24, 25, 30])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    docs = spark.range(6000).selectExpr("id AS doc_id", "'x' AS text")
    rows = shard_documents(docs, ShardTree(n)).toPandas()
    moved = rows[rows["shard"] != rows.grown_shard]
    assert set(moved.grown_shard) == {n}
    assert abs(len(moved) - 6000 / (n + 1)) < 5 * math.sqrt(6000 / n)
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_shards_follow_their_weights(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    n = shard_documents(docs, ShardTree(8, weights=(4.0,) + (1.0,) * 7)).groupBy("shard").count().toPandas()
    share = n.set_index("shard")["count"] / 20000
    assert abs(share[0] - 4 / 11) < 0.02 and abs(share[5] - 1 / 11) < 0.02


def test_toxic_rows_are_found_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = Q.op4_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    toxic = found.toxic == 1
    assert (found[toxic].predicted == 1).mean() > 0.8
    assert (found[~toxic].predicted == 1).mean() < 0.03
    assert found.score.between(0, 1).all()


def _sets(texts, k=4):
    out = {}
    for i, t in texts.items():
        w = WORDS.findall(t.encode().lower())
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def _components(sets, percent=85):
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def test_near_duplicates_against_all_pairs(spark, texts):
    found = Q.op5_jaccard_join(spark, SF).collect()
    sets = _sets(texts)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in found} == _components(sets)


def test_near_duplicates_around_the_threshold(docs_of):
    rng = np.random.default_rng(3)
    rows = []
    for base in range(6):
        words = [f"w{base}x{i}" for i in range(60 if base else 12)]
        for _ in range(14):
            copy = list(words)
            for at in rng.integers(0, len(words), rng.integers(0, 4)):
                copy[at] = f"n{rng.integers(1 << 30)}"
            rows.append(" ".join(copy + ["the", "common", "tail", "of", "all", "texts"]))
    docs = docs_of(*rows)
    for sim in (Similarity(), Similarity(common=3, rounds=0), Similarity(counted=0.02, rounds=1, tests=1)):
        found = {r.doc_id: r.component_id for r in near_duplicates(docs, sim).collect()}
        assert found == _components(_sets(dict(enumerate(rows))))


def test_rows_without_id_or_of_one_id_link_others(docs_of):
    same = [f"a{i}" for i in range(60)]
    ends = [" ".join([*same, *(f"b{i}" for i in range(6))]), " ".join([*(f"c{i}" for i in range(6)), *same])]
    for middle in ([(None, " ".join(same))], [(None, " ".join(same))] * 3, [(5, " ".join(same))] * 3, [(1, " ".join(same))]):
        docs = docs_of((1, ends[0]), (2, ends[1]), *middle, (None, "a text of other words"))
        found = {(r.doc_id, r.component_id, r.n_shingles) for r in near_duplicates(docs).collect()}
        assert found == {(1, 1, 63), (2, 1, 63), (middle[0][0], 1, 57), (None, None, 2)}


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(201)}


def test_components_end_with_the_step_that_makes_stars(spark, monkeypatch):
    made = []
    monkeypatch.setattr(parts, "written", lambda df, name: made.append(name) or written(df, name))
    star = spark.range(100).where("id <> 60").selectExpr("id AS a", "60L AS b")
    assert {(r.node, r.component) for r in components(star).collect()} == {(i, 0) for i in range(100)}
    assert made == ["edges", "edges"]
    assert components(star.where("a < 0")).count() == 0


def test_a_step_towards_components_runs_its_joins_once(spark):
    now = spark.createDataFrame([(2, 1), (3, 2), (4, 2)], "u long, v long")
    plan = parts._step(now)._jdf.queryExecution().optimizedPlan().toString()
    # The first join stands below both sides of the second; nothing else repeats it.
    assert len(re.findall(r"\bJoin\b", plan)) == 3 and "Union" not in plan


def test_components_do_not_depend_on_how_many_tasks_their_pairs_get(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2)) if a != b] + [(i, i + 1) for i in range(400, 440)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    few = {(r.node, r.component) for r in components(edges).collect()}
    monkeypatch.setattr(common, "TASK_ROWS", 16)
    assert {(r.node, r.component) for r in components(edges).collect()} == few
    assert {c for n, c in few if n >= 400} == {400} and all(c <= n for n, c in few)
    assert all((a, c) in few and (b, c) in few for a, b in pairs for c in [dict(few)[a]])


def test_a_small_table_is_one_file_and_a_large_one_several(spark, monkeypatch):
    """With many shuffle partitions, steps towards components read and write one file each."""
    files = []
    monkeypatch.setattr(parts, "written", lambda df, name: files.append(written(df, name)) or files[-1])
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.range(100).selectExpr("id AS a", "id + 1 AS b")
        assert components(edges).where("component = 0").count() == 101
        assert len(files) > 2 and {len(f.inputFiles()) for f in files[1:]} == {1}
        del files[:]
        monkeypatch.setattr(common, "TASK_ROWS", 10)
        assert components(edges).where("component = 0").count() == 101
        assert len(files[1].inputFiles()) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_links_left_over_take_stars_only_where_pairs_are_many(docs_of, monkeypatch):
    """A leader that all are like but no two of the rest: those are looked at in pairs, unless many share what sets them apart."""
    rng = np.random.default_rng(11)
    rows = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(100)]
        for _ in range(40):
            copy = list(words)
            for at in rng.integers(0, len(words), rng.integers(0, 7)):
                copy[at] = f"n{rng.integers(6)}"
            rows.append(" ".join(copy))
    starred = []
    stars = minhash._starred
    monkeypatch.setattr(minhash, "_starred", lambda *a: starred.append(1) or stars(*a))
    docs, right = docs_of(*rows), _components(_sets(dict(enumerate(rows))))
    for pairs in (32, -1):
        monkeypatch.setattr(joined, "MinHash", lambda words, percent, pairs, use=pairs: minhash.MinHash(words=words, percent=percent, pairs=use))
        found = near_duplicates(docs, Similarity(common=3, rounds=0))
        assert {r.doc_id: r.component_id for r in found.collect()} == right
        assert bool(starred) == (pairs < 0)


def test_cells_are_opened_once_for_what_rounds_leave_over(docs_of, monkeypatch):
    made = []
    monkeypatch.setattr(joined, "written", lambda df, name: made.append(name) or written(df, name))
    same = [f"a{i}" for i in range(60)]
    texts = [" ".join([*same, f"b{i}", "of", "all"]) for i in range(4)]
    found = near_duplicates(docs_of(*texts, "a text of other words"), Similarity(rounds=0, common=3)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 4)}
    assert made.count("open") == 1


def test_base_and_model_scores(spark, texts):
    found = Q.op6_class_lm(spark, SF).toPandas().set_index("doc_id")
    tokens = {i: [*WORDS.findall(t.encode().lower()), b"\n"] for i, t in texts.items()}
    count = Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(t)
    n, v = sum(count.values()), len(count)
    for i, t in tokens.items():
        r = found.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t), rel=1e-9)
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_ids_equal_the_tokenizers_library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["", " ", "<|endoftext|> x", "a" * 3000, "\r\n\t é漢字😀", "don't  STOP"]
    for text in [*texts.values()][:60] + odd:
        assert encode(text, byte_bpe_50k()).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_packing_round_trip(spark, texts):
    found = Q.op7_packing(spark, SF).toPandas()
    fill = found.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and sorted(fill.index) == list(range(len(fill)))
    assert fill.sum() / (2048 * len(fill)) > 0.95
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert s.offset.to_list() == [0, *np.cumsum(s.length)[:-1]]
    for doc_id, p in found.sort_values("start").groupby("doc_id"):
        ids = encode(texts[doc_id], byte_bpe_50k())
        assert p.start.to_list() == [0, *np.cumsum(p.length)[:-1]] and p.length.sum() == len(ids)
        for r in p.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_shortest_pack_first_takes_the_shortest_pack():
    assert sorted(shortest_pack_first({6: 1, 5: 1, 3: 2}, 10)) == [((5, 3), 1), ((6, 3), 1)]
    packs = shortest_pack_first({7: 1000, 2: 2500, 1: 100}, 10)
    assert sum(n for _, n in packs) == 1000 + math.ceil((2500 - 1000) / 5)


def test_search_equals_brute_force(spark, texts):
    rows = {i: Counter(WORDS.findall(t.encode().lower())) for i, t in texts.items()}
    size = {i: sum(c.values()) for i, c in rows.items()}
    n = sum(s > 0 for s in size.values())
    avg, df = sum(size.values()) / n, Counter(w for c in rows.values() for w in c)
    docs = table(spark, SF, "documents")
    small = Search(shard=60, queries=4, block=8, batch=3, dense=16)
    for s in (Search(), small):
        found = search(docs, docs.where("doc_id % 20 = 0"), s).toPandas()
        for q in [i for i in rows if i % 20 == 0]:
            score = {}
            for i, c in rows.items():
                shared = [w for w in rows[q] if w in c]
                if shared:
                    idf = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in shared}
                    score[i] = sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[i] / avg)) for w in shared)
            best = sorted(score, key=lambda i: (-round(score[i], 6), i))[:10]
            assert found[found.query_id == q].sort_values("rank").doc_id.to_list() == best


def test_documents_with_negative_ids_are_found(docs_of):
    docs = docs_of((-7, "red green blue"), (-1, "red green blue"), (0, "red green blue"), (3, "red other words"), (-2, "nothing shared"))
    found = search(docs, docs.where("doc_id IN (-7, 3)"), Search(k=3)).collect()
    best = {q: [r.doc_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (-7, 3)}
    assert best == {-7: [-7, -1, 0], 3: [3, -7, -1]}


def test_query_rows_of_one_id_are_answered_each(docs_of):
    docs = docs_of((1, "red green"), (2, "blue grey"), (3, "red"), (4, "grey"))
    queries = docs_of((20, "red"), (20, "grey blue"), (20, "blue grey"), (None, "red"), (40, ""))
    found = search(docs, queries, Search(k=2)).collect()
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in found) == [(20, 1, 2), (20, 1, 3), (20, 2, 1), (20, 2, 4)]


def test_a_text_is_cut_and_sketched_once_for_itself_and_the_row_before(docs_of):
    plan = fingerprints(docs_of("a b", "c d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2  # the text, and the edited text


def test_next_columns_are_those_of_the_next_text(docs_of):
    rows = [(3, "c"), (1, None), (2, "bb"), (None, "n"), (2, "ba")]
    added = lambda rows: rows.withColumn("twice", F.concat("text", "text"))
    found = prints.with_next(docs_of(*rows), added).collect()
    assert {(r.doc_id, r.text, r.twice, r.next_text, r.next_twice) for r in found} == {
        (None, "n", "nn", "", ""), (1, "", "", "ba", "baba"), (2, "ba", "baba", "bb", "bbbb"),
        (2, "bb", "bbbb", "c", "cc"), (3, "c", "cc", "", ""),
    }


def test_fingerprints_and_edited_texts(spark, texts):
    found = Q.op9_fingerprints(spark, SF).toPandas().set_index("doc_id")
    ids, seen = sorted(texts), {}
    for i, nxt in zip(ids, [*ids[1:], ids[0]]):
        t, k = texts[i], len(texts[i]) // 4
        edited = t[: len(t) - k] + texts[nxt][:k]
        assert found.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(t, found.fingerprint[i]) == found.fingerprint[i]
    assert found.near_edited.between(0, 1).all() and found.near_next.between(0, 1).all()
    assert found.near_edited.median() > 0.45 and found.near_next.median() < 0.05


def test_targets_are_shared_and_cut(spark):
    sums = spark.createDataFrame([("b", 100), ("a", 10), (None, 1000), ("c", 50)], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(sums).collect()}
    weight, most = {"a": 1, "b": 2, "c": 3, None: 1}, {"a": 30.0, "b": 300.0, "c": 150.0, None: 3000.0}
    want, cut = {}, set()
    while True:
        left = 1160 - sum(most[s] for s in cut)
        want = {s: most[s] if s in cut else left * w / sum(weight[x] for x in weight if x not in cut) for s, w in weight.items()}
        over = {s for s in want if want[s] > most[s] + 1e-9}
        if not over:
            break
        cut |= over
    assert got == pytest.approx(want)


def test_mix_meets_its_targets(spark):
    a, b = (Q.op10_mixing(spark, SF).toPandas() for _ in range(2))
    assert a.sort_values("doc_id").reset_index(drop=True).equals(b.sort_values("doc_id").reset_index(drop=True))
    assert (a.taken <= 3 * a["size"]).all()
    assert a.target.groupby(a.target).first().sum() > 0
    source = a.merge(table(spark, SF, "documents").select("doc_id", "source").toPandas())
    by = source.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.largest).all()


def test_mixed_documents_repeat_as_taken(spark):
    docs = table(spark, SF, "documents")
    copies = Q.op10_mixing(spark, SF).toPandas().set_index("doc_id").copies
    got = Counter(r.doc_id for r in mixed_documents(docs).select("doc_id").collect())
    assert got == Counter({i: int(n) for i, n in copies.items() if n})


def _likeness(*texts):
    a, b = ({ln for t in x.split("\n") for ln in [t]} for x in texts)
    return len(a & b) / len(a | b)


def test_added_lines_and_words_leave_the_other_paragraphs(docs_of):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    lines = "\n".join(word() for _ in range(3000))
    other = "\n".join(word() for _ in range(2000))
    run = " ".join(word() for _ in range(4000))
    spaceless = "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 5000, 4000))
    rows = [lines, "in front\n" + lines, other, run, "one " + run, spaceless, "一" + spaceless]
    near = {r.doc_id: r.near_next for r in fingerprints(docs_of(*rows)).collect()}
    assert near[0] == pytest.approx(3000 / 3001, abs=1e-3)
    assert near[1] == pytest.approx(_likeness(rows[1], other), abs=1e-3)
    assert near[3] > 0.97 and near[5] > 0.97
    assert near[2] == near[4] == 0.0


def _apart(rows):
    found = rows.select(prints.differing(F.col("a"), F.col("b")).alias("d")).collect()
    return [None if r.d is None else set(r.d) for r in found]


def test_digests_that_share_their_cells_are_told_apart(spark, monkeypatch):
    places = [F.expr(f"pmod(xxhash64(id, {t}), 128)").alias(f"p{t}") for t in range(3)]
    met = spark.range(9000).select("id", *places).groupBy("p0", "p1", "p2").agg(F.collect_list("id").alias("ids")).where("size(ids) = 2")
    pairs = [sorted(r.ids) for r in met.collect()]
    assert pairs
    rows = spark.createDataFrame([([*p, -1], [-1]) for p in pairs] + [([p[0], -1], [p[1], -1]) for p in pairs], "a array<long>, b array<long>")
    assert _apart(rows) == [set(p) for p in pairs] * 2
    # Nothing peels: the sets are compared as they are.
    monkeypatch.setattr(prints, "ROUNDS", 1)
    many = [(list(range(i, 300 + i)), list(range(100, 400 + i))) for i in range(4)]
    rows = spark.createDataFrame(many, "a array<long>, b array<long>")
    assert _apart(rows) == [set(a) ^ set(b) for a, b in many]
