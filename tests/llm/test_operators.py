"""The numbered operators against brute-force versions and edge rows."""

import collections
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from feedlens.llm import dedup, jaccard, mixing, ngram_lm, packing, quality, queries, sharding, token_scan, toxicity, urls, winnow
from feedlens.llm.components import connected_components
from feedlens.llm.tables import materialize
from feedlens.session import scratch_path

from .conftest import SF001, SF01

ASCII_LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ op1

def brute_mix(docs, weights, budget, epochs, seed):
    """(doc_id, epoch) -> tokens by a tree walk and sorted lists."""
    tree = {}
    for d in docs:
        if d["tokens"] > 0:
            tree.setdefault(d["domain"], {}).setdefault(d["lang"], {}).setdefault(d["source"], []).append(d)
    weight = {w[:3]: w[3] for w in weights}

    def cap(node):
        return sum(d["tokens"] for d in node) * epochs if isinstance(node, list) else sum(map(cap, node.values()))

    def fill(children, total):
        """children: {name: (weight, capacity)}"""
        given, left, still = {}, total, dict(children)
        while still:
            unit = left / sum(w for w, _ in still.values())
            full = {n for n, (w, c) in still.items() if c <= unit * w + 1e-9}
            if not full:
                return given | {n: unit * w for n, (w, _) in still.items()}
            for n in full:
                given[n] = still.pop(n)[1]
                left -= given[n]
        return given

    out = collections.Counter()

    def walk(node, path, total):
        if isinstance(node, list):
            total = int(total + 1e-6)
            epoch = 0
            while total > 0 and epoch < epochs:
                key = lambda d: (hashlib.md5(f"{seed}|{epoch}|{d['doc_id']}".encode()).hexdigest(), d["doc_id"])
                for d in sorted(node, key=key):
                    take = min(total, d["tokens"])
                    if take > 0:
                        out[d["doc_id"], epoch] += take
                    total -= take
                epoch += 1
            return
        named = {n: (weight.get((*path, n, None, None)[:3], 1.0), cap(c)) for n, c in node.items()}
        for n, share in fill(named, total).items():
            walk(node[n], (*path, n), share)

    walk(tree, (), budget)
    return out


@pytest.mark.parametrize("budget", [None, 5000.0, 10 ** 9])
def test_mix_equals_a_tree_walk(spark, documents, budget):
    docs = queries.mix_documents(documents)
    rows = [r.asDict() for r in docs.collect()]
    got = collections.Counter()
    for r in mixing.mix(docs, queries.mix_weights(spark), budget, 3, 5).collect():
        assert 0 < r.taken <= r.tokens
        got[r.doc_id, r.epoch] += r.taken
    total = float(sum(r["tokens"] for r in rows)) if budget is None else budget
    assert got == brute_mix(rows, queries.MIX_WEIGHTS, total, 3, 5)


def test_mix_edges(spark, edge, empty):
    assert mixing.mix(queries.mix_documents(empty), queries.mix_weights(spark), None, 2, 1).count() == 0
    out = mixing.mix(queries.mix_documents(edge), queries.mix_weights(spark), 10 ** 9, 2, 1)
    known = queries.mix_documents(edge).agg(F.sum("tokens")).first()[0]
    assert out.agg(F.sum("taken")).first()[0] == 2 * known


# ------------------------------------------------------------------ op2

def brute_components(rows):
    sets = []
    for doc_id, text in rows:
        w = words(text)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)].append(doc_id)
    return sorted(((doc_id, len(s), min(ids[root(i)], default=None) if s else doc_id)
                   for i, ((doc_id, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_jaccard_components_equal_brute_force(spark, documents, edge):
    for docs in (documents, edge):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert rows_of(jaccard.ngram_jaccard_components(docs)) == brute_components(rows)


def test_jaccard_chains_of_near_copies(spark, monkeypatch):
    """Many copies with few edits each, around the threshold, and split lists."""
    import random

    monkeypatch.setattr(jaccard, "LIST_ROWS", 1)
    rng = random.Random(3)
    rows = []
    for base in range(3):
        text = [f"b{base}w{i}" for i in range(50)]
        for i in range(40):
            own = list(text)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(50)] = f"e{rng.randrange(10 ** 6)}"
            rows.append((base * 100 + i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"u{i}x{j}" for j in range(12)) + " " + " ".join(f"p{j}" for j in range(30))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.ngram_jaccard_components(df)) == brute_components(rows)


@pytest.mark.parametrize("head_sets", [16, 2])
def test_jaccard_links_inside_a_lone_group(spark, monkeypatch, head_sets):
    import numpy as np

    # A base and two copies, one edited near its start and one near its end:
    # each copy links with the base (27 / 33) and not with the other (24 / 36).
    # Where all three have one prefix and a copy has the smallest digest, the
    # base's link with the other copy lies inside a group that meets no other.
    monkeypatch.setattr(jaccard, "shingle_counts", lambda *a: np.zeros(2, np.int32))
    monkeypatch.setattr(jaccard, "HEAD_SETS", head_sets)
    rows, base_of = [], {}
    for t in range(300):
        base = [f"t{t}w{i}" for i in range(34)]
        start, end = list(base), list(base)
        start[2], end[-3] = "changed", "changed"
        for j, text in enumerate((base, start, end)):
            rows.append((3 * t + j, " ".join(text)))
            base_of[3 * t + j] = 3 * t
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard_components(df).collect()}
    assert found == base_of


def count_verified(monkeypatch):
    """Rows that go into and come out of each verification."""
    seen, verify = [], jaccard._verify

    def counted(docs, nodes, pairs, k, percent):
        links = materialize(verify(docs, nodes, pairs, k, percent), "jaccard-counted")
        seen.append((pairs.count(), links.count()))
        return links

    monkeypatch.setattr(jaccard, "_verify", counted)
    return seen


def test_jaccard_repeated_rows_of_one_id_make_one_link(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    near, lone = base[:-1] + ["other"], [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(words)) for i, words in ((1, base), (2, near), (None, lone), (None, near)) for _ in range(2500)]
    seen = count_verified(monkeypatch)
    found = jaccard.ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(16))
    counts = {tuple(r)[:3]: r["count"] for r in found.groupBy("doc_id", "n_shingles", "component_id").count().collect()}
    assert counts == {(1, 56, 1): 2500, (2, 56, 1): 2500, (None, 26, None): 2500, (None, 56, 1): 2500}
    assert sum(links for _, links in seen) == 1


@pytest.mark.parametrize("documents", [100, 300])
def test_jaccard_boilerplate_pairs_are_linear(spark, monkeypatch, documents):
    # With two counters nothing tells the shared half from the own words at first.
    boiler = " ".join(f"b{i}" for i in range(60))
    own = [[f"d{d}w{i}" for i in range(60)] for d in range(documents)]
    rows = [(d, boiler + " " + " ".join(words)) for d, words in enumerate(own)]
    rows += [(documents + d, boiler + " " + " ".join(own[d][:-2] + ["x", "y"])) for d in range(0, documents, 10)]
    seen = count_verified(monkeypatch)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard_components(df, bits=1).collect()}
    assert found == {d: d - documents if d >= documents else d for d, _ in rows}
    # A set posts 24 shingles; all pairs of a list would be len(rows) ** 2 / 2.
    assert sum(pairs for pairs, _ in seen) <= 24 * len(rows)


def test_jaccard_empty_table_and_stage(spark, empty, edge):
    assert jaccard.ngram_jaccard_components(empty).count() == 0
    kept = jaccard.keep_one_of_each(edge)
    assert kept.columns == edge.columns
    assert {1, 5, 6, 7, 8, 10, 12, 13, 14, 15} <= {r.doc_id for r in kept.collect()}
    assert not {2, 3, 4, 9} & {r.doc_id for r in kept.collect()}


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7), (300, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100, 300: 100}


# ------------------------------------------------------------------ op3

def test_shards_by_bytes(spark, edge, empty):
    store = sharding.SlotMapStore(spark, scratch_path(spark, "map"))
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = sharding.shard_documents(docs, 16, store).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    total = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(total) == set(range(16))
    assert max(total.values()) < 1.1 * min(total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard_documents(edge, 4, sharding.SlotMapStore(spark, scratch_path(spark, "map")), 64)
    assert again.count() == edge.count()
    assert sharding.shard_documents(empty, 4, sharding.SlotMapStore(spark, scratch_path(spark, "map")), 64).count() == 0


def test_sharding_takes_its_shards_from_an_edited_version(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    store = sharding.SlotMapStore(spark, scratch_path(spark, "map"))
    assert store.latest() == 0
    rows = sharding.shard_documents(docs, 16, store, shards_before=12).collect()
    first, second = store.placed(1), store.placed(2)
    assert store.latest() == 2 and set(first.values()) == set(range(12)) and set(second.values()) == set(range(16))
    assert all(r.shard == second[r.virtual_slot] for r in rows)
    # Slots move to the new shards only as far as the balance asks for.
    stayed = sum(first[s] == second[s] for s in first)
    assert stayed > 0.5 * len(first)
    total = collections.Counter()
    for r in rows:
        total[r.shard] += r.size
    assert max(total.values()) < 1.1 * min(total.values())
    again = sharding.shard_documents(docs, 16, store).collect()
    assert store.latest() == 3 and {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in rows}


def test_a_shard_with_one_large_slot_leaves_the_rest_to_balance():
    sizes = {0: 10_000, **{s: 10 for s in range(1, 400)}}
    placed = {s: 0 if s == 0 else 1 + s % 2 for s in sizes}
    got = sharding.rebalanced(placed, sizes, 5)
    total = collections.Counter()
    for s, shard in got.items():
        total[shard] += sizes[s]
    assert total[0] == 10_000 and max(total[s] for s in range(1, 5)) <= 1010 and min(total[s] for s in range(1, 5)) >= 980


def test_rebalancing_edits_the_map(spark):
    sizes = {s: 10 + s % 7 for s in range(1000)}
    first = sharding.initial_map(sizes, 8, 1000)
    grown = sharding.rebalanced(first, sizes, 9)
    moved = [s for s in first if first[s] != grown[s]]
    assert all(grown[s] == 8 for s in moved) and 80 < len(moved) < 140
    total = collections.Counter()
    for s, shard in grown.items():
        total[shard] += sizes[s]
    assert max(total.values()) < 1.05 * min(total.values())
    back = sharding.rebalanced(grown, sizes, 8)
    assert set(back.values()) == set(range(8)) and all(back[s] == grown[s] for s in back if grown[s] != 8)
    store = sharding.SlotMapStore(spark, scratch_path(spark, "map"))
    store.save(1, first), store.save(2, grown)
    assert store.placed(1) == first and store.placed(2) == grown
    with pytest.raises(Exception):
        store.save(2, first)


# ------------------------------------------------------------------ op4, op10

def brute_model(texts, order=4):
    """Interpolated modified Kneser-Ney over symbols, as nested dictionaries."""
    def symbols(text):
        return [27] * (order - 1) + [int(ngram_lm._SYMBOL[b]) for b in text.encode()] + [27]

    level = collections.Counter()
    for text in texts:
        s = symbols(text)
        level.update(tuple(s[i:i + order]) for i in range(len(s) - order + 1))
    levels = [level]
    while len(next(iter(level))) > 1:
        level = collections.Counter(g[1:] for g in level)
        levels.append(level)

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        raw = (1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0,
               3 - 4 * y * n[3] / n[2] if n[2] else 1.5)
        return [min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1)]

    def p(gram, depth=0):
        if not gram:
            return 1 / 32
        c, d = levels[depth], discounts(levels[depth])
        cut = lambda v: d[min(v, 3) - 1]
        same = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        lower = p(gram[1:], depth + 1)
        if not same:
            return lower
        own = c.get(gram, 0)
        return (max(own - cut(own), 0) if own else 0) / sum(same) + sum(map(cut, same)) / sum(same) * lower

    return p, symbols


def test_kneser_ney_equals_a_direct_version(spark):
    import math

    import numpy as np

    texts = ["the cat sat on the mat", "the dog sat", "a cat", "Ünï 12 THE!"]
    other = ["zzz the cat", ""]
    docs = spark.createDataFrame([(t, True) for t in texts] + [(t, False) for t in other], "text string, trusted boolean")
    counts = materialize(ngram_lm.count_grams(docs.withColumn("any", F.lit(True)), ["trusted", "any"]), "lm-test")
    trained = counts.select("gram", F.col("trusted").alias("a"))
    lower = ngram_lm.backoff_probabilities(trained, counts)
    top = {r.gram: r.p for r in ngram_lm.top_probabilities(trained, counts, lower).collect()}
    p, symbols = brute_model(texts)
    for gram, got in top.items():
        parts = tuple(int(x) for x in (gram // 32 ** 3, gram // 32 ** 2 % 32, gram // 32 % 32, gram % 32))
        assert math.isclose(got, p(parts), rel_tol=1e-9), parts
    # All continuations of a history have probability 1 together.
    grams = spark.range(32).select((F.lit(20 * 32 ** 3 + 8 * 32 ** 2 + 5 * 32) + F.col("id")).alias("gram"))
    low = ngram_lm.backoff_probabilities(trained, grams)
    assert abs(ngram_lm.top_probabilities(trained, grams, low).agg(F.sum("p")).first()[0] - 1) < 1e-9
    table = np.zeros(ngram_lm.GRAMS, np.float32)
    for g, v in top.items():
        table[g] = math.log(v)
    scored = docs.select("text", ngram_lm.gram_scores(spark, table).alias("s")).collect()
    for r in scored:
        s = symbols(r.text)
        expected = [math.log(p(tuple(s[i:i + 4]))) for i in range(len(s) - 3)]
        assert r.s.grams == len(expected) and math.isclose(r.s.total, sum(expected), rel_tol=1e-4)


def test_long_runs_are_scored_by_a_sharded_join(spark, monkeypatch):
    """n-grams grow with the corpus, and what is not frequent is joined by a shuffle."""
    import math

    monkeypatch.setattr(ngram_lm, "HOT", 6)
    monkeypatch.setattr(ngram_lm, "HELD", 5)
    texts = ["the cat sat on the mat", "the dog sat", "a cat", "Ünï 12 THE!", "the cat sat on the mat"]
    rows = [(i if i % 2 else None, t) for i, t in enumerate([*texts, "zzz the cat", "", None, "zzz the cat"])]
    docs = spark.createDataFrame([(i, t, j < len(texts)) for j, (i, t) in enumerate(rows)], "id int, text string, trusted boolean")
    classes = docs.withColumn("any", F.lit(True))
    counts = materialize(ngram_lm.count_grams(classes, ["trusted", "any"], order=6), "lm-test")
    p, symbols = brute_model(texts, 6)

    def number(gram):
        return sum(x * 32 ** (5 - j) for j, x in enumerate(gram))

    def runs(text):
        s = symbols(text or "")
        return [tuple(s[i:i + 6]) for i in range(len(s) - 5)]

    want = {name: collections.Counter(number(g) for t in part for g in runs(t))
            for name, part in (("trusted", texts), ("any", [t for _, t in rows]))}
    for r in counts.collect():
        assert (r.trusted, r["any"]) == (want["trusted"][r.gram], want["any"][r.gram])
    assert counts.count() == len(want["any"])
    trained = counts.select("gram", F.col("trusted").alias("a"))
    lower = ngram_lm.backoff_probabilities(trained, counts, 6)
    top = ngram_lm.top_probabilities(trained, counts, lower, 6)
    values = materialize(counts.select("gram", F.col("any").alias("n")).join(
        top.select("gram", F.log("p").alias("value")), "gram"), "lm-test-values")
    hot, _ = ngram_lm._hot(values, ["value"])
    assert 0 < len(hot) <= 6 < values.count()
    scored = ngram_lm.score_texts(docs.select("id", "text", F.col("text").alias("shown")), values, ["value"]).collect()
    assert sorted((r.id or -1, r.shown or "-") for r in scored) == sorted((i or -1, t or "-") for i, t in rows)
    for r in scored:
        expected = [math.log(p(g)) for g in runs(r.shown)]
        assert r.grams == len(expected) and math.isclose(r.value, sum(expected), rel_tol=1e-6)


def test_a_class_without_a_history_follows_the_shared_model(spark):
    shared = spark.createDataFrame([(1, 0.5), (2, 0.25), (40, 0.125)], "gram long, p double")
    found = {r.gram: r.p for r in ngram_lm.class_probabilities(
        spark.createDataFrame([(1, 300), (2, 100)], "gram long, a long"), shared, 6).collect()}
    # 1.5 of each count is free, and goes where the shared model says.
    assert found == {1: (298.5 + 3 * 0.5) / 400, 2: (98.5 + 3 * 0.25) / 400, 40: 0.125}


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    train = labels.where("doc_id % 3 <> 0")
    judged = quality.classify(docs, train).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.3 * len(bad)


def test_quality_thresholds_equal_a_direct_version(spark):
    import zlib

    import numpy as np

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    scores = quality.document_perplexity(docs, labels).toPandas()
    scores["lang"] = scores["lang"].fillna("")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert [zlib.crc32(texts[i].encode()) % 2 for i in scores["doc_id"]] == scores["half"].tolist()
    train = scores[scores.trusted]
    assert set(scores[scores.trusted].doc_id) == {r.doc_id for r in labels.where("quality = 1").collect()}

    def weighed(own, known, overall):
        return (known * own + quality.POOLED_WEIGHT * overall) / (known + quality.POOLED_WEIGHT)

    overall = train.total.sum() / train.grams.sum()
    pulled = {}
    for lang, rows in scores.groupby("lang"):
        own = train[train.lang == lang]
        mean = weighed(own.total.sum() / own.grams.sum(), len(own), overall) if len(own) else overall
        pulled.update(zip(rows.index, -(rows.total + 200 * mean) / (rows.grams + 200)))
    scores["pulled"] = [pulled[i] for i in scores.index]

    def quantile(values):  # the least value that at least 99.9 % do not exceed
        return np.sort(values)[int(np.ceil(0.999 * len(values))) - 1]

    setting = scores[scores.trusted]
    limits = {lang: quantile(setting.pulled) for lang in set(scores.lang)}
    for lang, rows in setting.groupby("lang"):
        limits[lang] = weighed(quantile(rows.pulled), len(rows), quantile(setting.pulled))
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == len(scores)
    for r in scores.itertuples():
        assert np.isclose(np.log(found[r.doc_id].perplexity), r.pulled, rtol=1e-5)
        assert np.isclose(np.log(found[r.doc_id].threshold), limits[r.lang], rtol=1e-5)
        assert found[r.doc_id].kept == (found[r.doc_id].perplexity <= found[r.doc_id].threshold)


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 1), (None, 1), (10, None), (14, 0)], "doc_id long, quality int")
    assert quality.classify(edge, labels).count() == edge.count()
    assert quality.classify(empty, labels).count() == 0
    unlabelled = quality.classify(edge, labels.where("quality = 7"))
    assert unlabelled.where("not kept or threshold is not null").count() == 0
    assert quality.keep_good(edge, labels).columns == edge.columns


def test_toxicity_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.toxicity_scores(docs, labels).collect()
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(scored) == docs.count()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    # Some toxic labels of this table are on texts without any toxic word.
    insult = re.compile("idiot|loser|scum|trash|stupid|moron|pathetic|disgusting|clown|worthless", re.I)
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [(r.predicted, known[r.doc_id], bool(insult.search(texts[r.doc_id]))) for r in scored
            if r.held_out and r.doc_id in known]
    assert sum(p for p, t, w in held if t and w) >= 0.9 * sum(t and w for _, t, w in held)
    assert sum(p for p, t, _ in held if not t) <= 0.02 * sum(not t for _, t, _ in held)


def test_toxicity_ignores_held_out_labels(spark, edge, empty):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.toxicity_scores(docs, labels)) == rows_of(toxicity.toxicity_scores(docs, flipped))
    some = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (None, 1), (10, None)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(edge, some).where("score is null").count() == 0
    assert toxicity.toxicity_scores(edge, some).count() == edge.count()
    assert toxicity.toxicity_scores(empty, some).count() == 0
    assert toxicity.toxicity_scores(edge, some.where("toxic = 9")).count() == edge.count()


# ------------------------------------------------------------------ op5

def test_url_rules(spark):
    cases = [
        (1, "http://a.NET/x", "a.net", "/x", "net/", "block"), (2, "https://www.example.net/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
        (3, "http://example.net/fr/", "example.net", "/fr/", "net/", "block"), (4, "http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        (5, "http://example.com/de/1?x#y", "example.com", "/de/1", "example.com/de/", "block"), (6, None, "", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"), (8, "http://net", "net", "", None, "allow"), (9, "x://b.org/fr/?q://r", "b.org", "/fr/", "org/fr/", "allow"),
        (10, "http://EXAMPLE.com?u=/de/", "example.com", "", None, "allow"), (11, "http://fishnet/", "fishnet", "/", None, "allow"),
    ]
    pages = spark.createDataFrame([c[:2] for c in cases], "page_id long, url string").withColumn("rule", F.lit(1))
    got = rows_of(urls.judge(pages, urls.DigestArray(spark, queries.URL_RULES)))
    assert got == sorted(((c[0], *c[2:]) for c in cases), key=repr)
    assert urls.judge(pages.limit(0), urls.DigestArray(spark, queries.URL_RULES)).count() == 0
    assert urls.judge(pages, urls.DigestArray(spark, [])).where("verdict <> 'allow'").count() == 0


# ------------------------------------------------------------------ op6

def test_winnowing_keeps_the_rightmost_minimum_of_each_window(spark, edge):
    k, w = 2, 3
    docs = edge.where("doc_id <> 13")
    gram = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), lambda x: F.xxhash64(x))
    rows = docs.select(gram.alias("h"), winnow.fingerprint(F.col("text"), k, w).alias("p")).select(
        "h", winnow.hashes(F.col("p")).alias("hashes"), winnow.positions(F.col("p")).alias("at")).collect()
    pairs = spark.createDataFrame([(i, j, r.h[j], r.h[j + 1] if j + 1 < len(r.h) else None)
                                   for i, r in enumerate(rows) for j in range(max(len(r.h) - 1, min(len(r.h), 1)))],
                                  "i int, j int, a long, b long")
    hashed = {(r.i, r.j): r.x & (2 ** 32 - 1) for r in pairs.select("i", "j", F.xxhash64("a", "b").alias("x")).collect()}
    for i, r in enumerate(rows):
        own = [hashed[i, j] for j in range(sum(1 for key in hashed if key[0] == i))]
        chosen = {}
        for start in range(max(len(own) - w, 0) + 1 if own else 0):
            window = own[start:start + w]
            at = max(start + x for x, v in enumerate(window) if v == min(window))
            chosen[at] = own[at]
        assert dict(zip(r.at, r.hashes)) == chosen


@pytest.mark.parametrize("ids", [
    [*range(0, 4000, 2), 2**50], [-2**63, 2**63 - 1, 0, None, None, *range(5, 900)], [7] * 1500 + [8, 9, None], [3]])
def test_winnow_follows_any_ids(spark, ids, monkeypatch):
    monkeypatch.setattr(winnow, "BLOCK_ROWS", 100)
    rows = [(d, f"text {j} of {d}") for j, d in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    follower = {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1])}
    got = winnow.winnow_documents(docs).select("doc_id", "text", "edited").collect()
    assert len(got) == len(rows)
    for r in got:
        half = len(r.text) // 2
        assert r.edited == r.text[:len(r.text) - half] + follower[r.text][:half]
    if len(set(ids)) > 1000:  # evenly filled whatever the distance of the ids
        keyed = docs.withColumn("key", F.col("doc_id"))
        sizes = [r["count"] for r in keyed.groupBy(winnow._block_of(keyed).alias("b")).count().collect()]
        assert len(sizes) >= 15 and max(sizes) < 250


def test_winnow_likeness_is_the_jaccard_similarity_of_the_hashes(spark):
    for r in queries.op6_winnowing(spark, SF001).collect():
        own, other = ({g.split(":")[0] for g in t.split()} for t in (r.fingerprint, r.edited_fingerprint))
        assert abs(r.near_edited - (len(own & other) / len(own | other) if own | other else 1.0)) < 1e-12


def test_winnow_edited_text_and_next_document(spark, documents, edge, empty):
    for docs in (documents, edge):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()),
                      key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        got = winnow.winnow_documents(docs).collect()
        expected = collections.Counter()
        for i, (doc_id, text) in enumerate(rows):
            half = len(text) // 2
            expected[doc_id, len(text), text[:len(text) - half] + rows[(i + 1) % len(rows)][1][:half]] += 1
        assert collections.Counter((r.doc_id, r.n_chars, r.edited) for r in got) == expected
    assert winnow.winnow_documents(empty).count() == 0
    out = queries.op6_winnowing(spark, SF001).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert sum(r.near_edited for r in out) > 5 * sum(r.near_next for r in out)
    assert "Python" not in queries.op6_winnowing(spark, SF001)._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ op7

def test_packing(spark, documents, edge, empty):
    for docs in (documents, edge):
        source = queries.pack_documents(docs)
        whole = collections.Counter()
        for r in source.collect():
            whole[r.doc_id] += r.tokens
        rows = packing.pack(source, 256, 50).collect()
        bins = collections.defaultdict(list)
        for r in rows:
            whole[r.doc_id] -= r.tokens
            bins[r.bin].append(r)
        assert not any(whole.values()) and len({r.doc_id for r in rows}) == len(whole)
        for held in bins.values():
            held.sort(key=lambda r: r.bin_offset)
            assert sum(r.tokens for r in held) <= 256
            assert len({r.source for r in held}) == len(held) == len({r.cluster for r in held})
            assert all(a.bin_offset + a.tokens == b.bin_offset for a, b in zip(held, held[1:]))
    assert packing.pack(queries.pack_documents(empty)).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    pieces = [(70, "a", 1), (60, "b", 2), (50, "c", 3), (30, "b", 4), (30, "a", 5), (40, "d", 3)]
    # 30/b fits 70/a exactly; 30/a goes to 60/b; 40/d may not join 50/c (cluster 3).
    assert packing.best_fit(pieces, 100) == [(0, 0), (1, 0), (2, 0), (0, 70), (1, 60), (3, 0)]


# ------------------------------------------------------------------ op8

@pytest.mark.parametrize("block", [4, 12, 64, 1 << 20])
def test_separator_scan_round_trip(spark, tmp_path, block):
    import numpy as np

    files = {"a.bin": [5, 6, 0, 7, 0, 0, 8, 9, 10, 11, 12, 13, 0], "b.bin": [0], "c.bin": [1, 2, 3], "d.bin": [], "e.bin": [3, 0, 4]}
    for name, ids in files.items():
        np.array(ids, "<u4").tofile(tmp_path / name)
    got = collections.defaultdict(list)
    for r in token_scan.separator_scan(token_scan.token_files(spark, str(tmp_path)), block).orderBy("file", "ordinal").collect():
        got[r.file].append((r.ordinal, r.first_token, r.n_tokens, r.ended))
    assert got == {"a.bin": [(0, 0, 2, True), (1, 3, 1, True), (2, 5, 0, True), (3, 6, 6, True)], "b.bin": [(0, 0, 0, True)],
                   "c.bin": [(0, 0, 3, False)], "e.bin": [(0, 0, 1, True), (1, 2, 1, False)]}


def test_token_counts_edges(spark, edge, empty):
    got = sorted(((r.doc_id, r.n_tokens) for r in token_scan.count_tokens(edge).collect()), key=repr)
    assert got == sorted(((r.doc_id, len(words(r.text))) for r in edge.collect()), key=repr)
    assert token_scan.count_tokens(empty).count() == 0


# ------------------------------------------------------------------ op9

def test_exact_duplicates(spark, edge, empty):
    rows = [(r.doc_id, (r.text or "").translate(ASCII_LOWER)) for r in edge.collect()]
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    got = dedup.exact_duplicates(edge).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    kept = collections.Counter()
    for r in got:
        group = by_text[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == max((i for i in group if i is not None), default=None)
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    left = dedup.drop_exact_duplicates(edge)
    assert left.columns == edge.columns and left.count() == len(groups)
    assert dedup.exact_duplicates(empty).count() == dedup.drop_exact_duplicates(empty).count() == 0


def test_full_filter_gives_the_same_result(spark, documents, monkeypatch):
    plain = rows_of(dedup.exact_duplicates(documents))
    monkeypatch.setattr(dedup, "SEGMENT_BITS", 64)
    monkeypatch.setattr(dedup, "MAX_BITS", 64)
    assert rows_of(dedup.exact_duplicates(documents)) == plain
