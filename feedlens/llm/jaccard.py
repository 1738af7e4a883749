"""Grouped prefix join: near-duplicate documents by shingle Jaccard.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.8.  The join finds all links between different sets
that are needed to know the connected components, exactly:

1. One pass over the text counts shingles into a table of fixed size.  These
   counts order all shingles from rare to common; any shared order is right,
   and a rare-first order keeps passages that many documents share out of
   the prefixes.
2. A second pass gives each document its set's size and digest and the
   *prefix*: the first ``n - ceil(0.8 n) + 1`` shingles in that order.  Sets
   that link share a shingle of their prefixes.  Documents with equal prefix
   and size form one *group*, which posts its prefix once.
3. In each shingle's posting list the group with the shingle nearest to the
   front of its prefix leads; every other group is paired with its leader
   only, and each set of a group with the group's first set.  The length and
   position filters drop pairs that cannot link, the rest are verified on the
   whole sets, and the links give first components.  This is linear in the
   postings however large a group of near copies is.
4. Groups that still meet in a list but lie in different components are
   expanded to their sets, filtered, paired and verified, so no link between
   components is lost.  A group of several sets is a list of its own here,
   whether it meets another group or not; in a large one a few more sets are
   first paired with all others, so that few components are left to pair.

The counters of step 1 have a fixed size, so on a large corpus a shingle that
many documents share may look rare and bring unlike documents together.  This
shows before step 4, as lists whose sets lie in many components.  Where such
lists would emit more pairs than there are postings, their shingles are put
behind all others, by the length of their lists, and steps 2 and 3 are
repeated with that order; digests, and so the links found, stay valid.

Whole sets are built again only for documents that meet another in a list,
once for each digest however many rows have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.llm import text
from feedlens.llm.components import connected_components
from feedlens.llm.tables import bounded, materialize, prepare_tasks, recorded, remove

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
#: Size of the shingle count table: 2**20 counters, 4 MB, whatever the input.
COUNT_BITS = 20
#: Counters travel in segments of this many.
SEGMENT = 4096
#: A posting list expected to be longer is split over several tasks first.
LIST_ROWS = 200_000
#: In a group with more sets in open components, so many further sets are
#: paired with the whole group before the rest is paired.
HEAD_SETS, HEAD_ROUNDS = 16, 3
#: A shingle is common if its list would emit more than so many pairs for each
#: entry.  At most so many common shingles are broadcast (16 MB), the longest
#: lists first, and the order is mended at most so often; pairs that are left
#: are then emitted as they are.
COMMON_PAIRS, COMMON_SHINGLES, ORDER_ROUNDS = 16, 1_000_000, 3


def _shingles(batches: Iterator[pa.RecordBatch], k: int):
    for batch in batches:
        for rows, data, offsets in text.text_chunks(batch):
            data = text.lower_ascii(data)
            starts, ends, ranges = text.word_spans(data, offsets)
            hashes, ranges = text.shingle_hashes(text.word_hashes(data, starts, ends), ranges, k)
            yield rows, hashes, ranges
    text.release_memory()


def shingle_counts(docs: DataFrame, k: int = SHINGLE_WORDS, bits: int = COUNT_BITS) -> np.ndarray:
    """How often shingles fall on each of ``2**bits`` counters, over all texts.

    Tasks count locally; the counters are added segment by segment, so what
    reaches the driver has a fixed size.
    """
    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for _, hashes, _ in _shingles(batches, k):
            np.add.at(total, (hashes >> np.uint64(64 - bits)).astype(np.int64), 1)
        for s in range(0, 1 << bits, SEGMENT):
            if total[s:s + SEGMENT].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s // SEGMENT], pa.int32()), pa.array([total[s:s + SEGMENT].astype("<i8").tobytes()])],
                    names=["segment", "counters"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[s] = sums.get(s, 0) + np.frombuffer(c, "<i8")
        for s, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([c.tobytes()])],
                                             names=["segment", "counters"])

    schema = "segment int, counters binary"
    merged = docs.select("text").mapInArrow(count, schema).repartition("segment").mapInArrow(add, schema)
    table = np.zeros(1 << bits, np.int64)
    for row in merged.toLocalIterator():
        table[row.segment * SEGMENT:(row.segment + 1) * SEGMENT] = np.frombuffer(row.counters, "<i8")
    return np.minimum(table, 2**31 - 1).astype(np.int32)


def _prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _frequencies(own: np.ndarray, counts: np.ndarray, shift: np.uint64,
                 common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per shingle its place in the order and the expected entries of its list."""
    expected = counts[(own >> shift).astype(np.int64)].astype(np.int64)
    shingles, entries = common
    if not len(shingles):
        return expected, expected
    at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
    known = shingles[at] == own
    return np.where(known, 2**31 + entries[at], expected), np.where(known, entries[at], expected)


NONE_COMMON = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def document_sets(docs: DataFrame, counts: np.ndarray, k: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT,
                  common: tuple[np.ndarray, np.ndarray] = NONE_COMMON) -> DataFrame:
    """Per document ``(doc_id, n, sig, grp, prefix, part)``.

    ``common``: shingles, ascending, that come last in the order, and the
    entries of their lists.

    ``sig`` is a 128-bit digest of the whole set, ``grp`` of size and prefix.
    A task sends a group's prefix once, with its first document; ``part`` says
    which part of a long posting list the group is in, of how many
    (``part * 2**16 + parts``).
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, common))
    shift = np.uint64(64 - int(np.log2(len(counts))))
    schema = "doc_id long, n int, sig binary, grp long, prefix array<long>, part array<int>"

    def sets(batches):
        seen: set[int] = set()
        for rows, hashes, ranges in _shingles(batches, k):
            size, sig, grp, prefix, part = [], [], [], [], []
            for a, b in zip(ranges[:-1], ranges[1:]):
                own = np.unique(hashes[a:b])
                n = len(own)
                size.append(n)
                if not n:
                    sig.append(None), grp.append(None), prefix.append(None), part.append(None)
                    continue
                place, expected = _frequencies(own, shared.value[0], shift, shared.value[1])
                order = np.lexsort((own, place))[:_prefix_length(n, percent)]
                first = own[order].view(np.int64)
                sig.append(xxhash.xxh3_128_digest(own.tobytes()))
                g = xxhash.xxh3_64_intdigest(first.tobytes(), seed=n) - 2**63
                grp.append(g)
                if g in seen:
                    prefix.append(None), part.append(None)
                else:
                    seen.add(g)
                    parts = np.minimum(1 + expected[order] // LIST_ROWS, 2**14)
                    prefix.append(first), part.append(((g % parts) << 16) + parts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), pa.array(size, pa.int32()), pa.array(sig, pa.binary()),
                 pa.array(grp, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(part, pa.list_(pa.int32()))],
                names=["doc_id", "n", "sig", "grp", "prefix", "part"])

    return docs.select("doc_id", "text").mapInArrow(sets, schema)


def _needed(x: str, y: str, percent: int) -> F.Column:
    """Least intersection of two sets of these sizes that link."""
    return F.ceil(F.expr(f"{percent}D * ({x} + {y}) / {100 + percent}") - F.lit(1e-6))


def _may_link(x: str, xpos: str, y: str, ypos: str, percent: int) -> F.Column:
    """Length filter, and position filter at one shared prefix shingle: the
    intersection holds at most that shingle and what follows it in each set.
    At the first shared shingle this holds for every pair that links."""
    need = _needed(x, y, percent)
    return ((F.expr(f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"))
            & (F.col(x) - F.col(xpos) >= need) & (F.col(y) - F.col(ypos) >= need))


def posting_lists(sets: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Postings of lists with two groups or more (several tasks may send the
    same group):
    ``(token, grp, n, pos, lead, lead_n, lead_pos, parts, entries)``.

    A posting stays only where its position lets it link with the smallest
    set of its list."""
    postings = (sets.where("prefix is not null")
                .select("grp", "n", F.posexplode(F.arrays_zip("prefix", "part")).alias("pos", "e"))
                .select(F.col("e.prefix").alias("token"), F.col("e.part").alias("part"), "grp", "n", "pos"))
    ranked = Window.partitionBy("token", "part").orderBy("pos", "grp")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (postings
            .withColumns({"lead": F.first("grp").over(ranked), "lead_n": F.first("n").over(ranked),
                          "lead_pos": F.first("pos").over(ranked), "low": F.min("grp").over(whole),
                          "high": F.max("grp").over(whole), "entries": F.count("*").over(whole),
                          "least": F.min("n").over(whole)})
            .withColumn("parts", F.expr("part % 65536"))
            .withColumn("least", F.when(F.col("parts") == 1, F.col("least")).otherwise(0))
            .where("low <> high or parts > 1")
            .withColumn("least", F.greatest("least", F.ceil(F.expr(f"{percent}D * n / 100") - F.lit(1e-6))))
            .where(F.col("n") - F.col("pos") >= _needed("n", "least", percent))
            .drop("low", "high", "part", "least"))


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (leader, group), and of split lists (first leader, leader)."""
    within = (lists.where("grp <> lead").where(_may_link("n", "pos", "lead_n", "lead_pos", percent))
              .select(F.col("lead").alias("a"), F.col("grp").alias("b")))
    heads = lists.where("parts > 1").select("token", "lead", "lead_n", "lead_pos").distinct()
    top = heads.groupBy("token").agg(F.min(F.struct("lead_pos", "lead", "lead_n")).alias("t"))
    across = (heads.join(top, "token")
              .select("lead", "lead_n", "lead_pos", F.col("t.lead").alias("top"),
                      F.col("t.lead_n").alias("top_n"), F.col("t.lead_pos").alias("top_pos"))
              .where("lead <> top").where(_may_link("lead_n", "lead_pos", "top_n", "top_pos", percent))
              .select(F.col("top").alias("a"), F.col("lead").alias("b")))
    return within.union(across).distinct()


def _whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(sig, size, shingles)`` of the documents in ``wanted(doc)``, one row
    for each digest and task (rows may repeat an id)."""
    def build(batches):
        seen: set[bytes] = set()
        for _, hashes, ranges in _shingles(batches, k):
            sigs, sets = [], []
            for a, b in zip(ranges[:-1], ranges[1:]):
                own = np.unique(hashes[a:b])
                sig = xxhash.xxh3_128_digest(own.tobytes())
                if len(own) and sig not in seen:
                    seen.add(sig)
                    sigs.append(sig), sets.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.binary()), pa.array([len(x) for x in sets], pa.int32()),
                 pa.array(sets, pa.list_(pa.int64()))],
                names=["sig", "size", "shingles"])

    ids = bounded(wanted)
    rows = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc"]), "left_semi").select("text")
    return rows.mapInArrow(build, "sig binary, size int, shingles array<long>")


def _one_of_each(sets: DataFrame) -> DataFrame:
    """One row for each digest of the written ``sets``.  Only digests that
    several tasks sent are compared, so only their sets move."""
    repeated = materialize(sets.groupBy("sig").agg(F.count("*").alias("rows")).where("rows > 1").select("sig"),
                           "jaccard-repeated")
    if repeated.isEmpty():
        return sets
    repeated = bounded(repeated)
    return (sets.join(repeated, "sig", "left_anti")
            .unionByName(sets.join(repeated, "sig", "left_semi").dropDuplicates(["sig"])))


def _verify(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of set digests whose whole sets link."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    wanted = materialize(nodes.join(ends, "sig", "left_semi").select("doc").distinct(), "jaccard-wanted")
    sets = _one_of_each(materialize(_whole_sets(docs, wanted, k), "jaccard-whole"))
    left = sets.select(F.col("sig").alias("a"), F.col("size").alias("a_size"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("sig").alias("b"), F.col("size").alias("b_size"), F.col("shingles").alias("b_set"))
    return (pairs.join(right, "b").join(left, "a")
            .withColumn("both", F.size(F.array_intersect("a_set", "b_set")))
            .where(f"100 * both >= {percent} * (a_size + b_size - both)")
            .select("a", "b"))


def _new_pairs(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct pairs, smaller digest first, without those in ``done``."""
    return (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))


def _head_pairs(several: DataFrame, heads: DataFrame, components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next heads ``(grp, head)`` of the large groups that lie in several
    components, and their pairs with the group's sets in other components."""
    sets = (several.join(components.select(F.col("node").alias("sig"), "component"), "sig", "left")
            .withColumn("component", F.coalesce("component", "sig")))
    large = (sets.groupBy("grp").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x <> y").where(F.col("size") > HEAD_SETS).select("grp"))
    sets = materialize(sets.join(large, "grp", "left_semi"), "jaccard-open")
    later = sets.join(heads, "grp").where("sig > head")
    heads = materialize(later.groupBy("grp").agg(F.min(F.struct("sig", "component")).alias("h"))
                        .select("grp", F.col("h.sig").alias("head"), F.col("h.component").alias("own")), "jaccard-heads")
    pairs = sets.join(heads, "grp").where("component <> own").select(F.col("head").alias("a"), F.col("sig").alias("b"))
    return heads.select("grp", "head"), pairs


def _open_members(lists: DataFrame, nodes: DataFrame, several: DataFrame, components: DataFrame) -> DataFrame:
    """``(token, grp, n, pos, inner, sig, component)``: the sets of lists, and
    of groups (``inner``), that lie in several components."""
    # A list of two groups is settled by its one pair, unless a group holds
    # several sets; other lists are settled where all sets are in one component.
    groups = materialize(several.groupBy("grp").agg(F.first("n").alias("n")), "jaccard-several")
    several = groups.select("grp")
    with_several = materialize(lists.join(bounded(several), "grp", "left_semi").select("token").distinct(), "jaccard-tokens")
    rest = lists.where("entries <= 2 and parts = 1").join(bounded(with_several), "token", "left_semi")
    open_lists = lists.where("entries > 2 or parts > 1").unionByName(rest).select("token", "grp", "n", "pos").distinct()
    open_lists = open_lists.withColumn("inner", F.lit(False))
    open_lists = open_lists.unionByName(groups.select(F.col("grp").alias("token"), "grp", "n", F.lit(0).alias("pos"), F.lit(True).alias("inner")))
    members = (open_lists.join(nodes.select("grp", "sig"), "grp")
               .join(components.select(F.col("node").alias("sig"), "component"), "sig", "left")
               .withColumn("component", F.coalesce("component", "sig")))
    members = materialize(members, "jaccard-members")
    mixed = (members.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x <> y").select("token"))
    return members.join(mixed, "token", "left_semi")


def _common_shingles(members: DataFrame, postings: int,
                     common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """``common`` and the shingles whose lists would emit most pairs of sets in
    different components, or None where all pairs are no more than
    ``postings`` or no shingle is left to add."""
    sizes = members.where("not inner").groupBy("token", "component").agg(F.count("*").alias("m"))
    lists = (sizes.groupBy("token").agg(F.sum("m").alias("entries"), F.sum(F.expr("double(m) * m")).alias("same"))
             .withColumn("pairs", F.expr("(double(entries) * entries - same) / 2"))
             .where(F.col("pairs") > COMMON_PAIRS * F.col("entries")).drop("same"))
    lists = materialize(lists, "jaccard-common")
    if (lists.agg(F.sum("pairs")).first()[0] or 0) <= postings:
        return None
    shingles, entries = common
    found = lists.orderBy(F.desc("pairs"), "token").select("token", "entries").limit(COMMON_SHINGLES).toPandas()
    token = found["token"].to_numpy(np.int64).view(np.uint64)
    new = np.flatnonzero(~np.isin(token, shingles))[:COMMON_SHINGLES - len(shingles)]
    if not len(new):
        return None
    shingles = np.concatenate([shingles, token[new]])
    entries = np.concatenate([entries, found["entries"].to_numpy(np.int64)[new]])
    order = np.argsort(shingles)
    return shingles[order], entries[order]


def _cross_pairs(members: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that meet in a list or a group, may link, lie in
    different components and were not verified before."""
    a = members.select("token", *(F.col(c).alias(f"a_{c}") for c in ("sig", "n", "pos", "component")))
    b = members.select("token", *(F.col(c).alias(f"b_{c}") for c in ("sig", "n", "pos", "component")))
    return _new_pairs(a.join(b, "token")
                      .where("a_sig < b_sig and a_component <> b_component")
                      .where(_may_link("a_n", "a_pos", "b_n", "b_pos", percent))
                      .select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b")), done)


def _first_components(docs: DataFrame, nodes: DataFrame, lists: DataFrame, pairs: DataFrame, links: DataFrame,
                      k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Pairs verified so far, their links and components, and the sets of
    groups that hold several: step 3, added to the ``pairs`` and ``links`` of
    an earlier order."""
    first = materialize(nodes.groupBy("grp").agg(F.min("sig").alias("head"), F.max("sig").alias("tail")), "jaccard-first")
    heads_a = first.select(F.col("grp").alias("a"), F.col("head").alias("a_sig"))
    heads_b = first.select(F.col("grp").alias("b"), F.col("head").alias("b_sig"))
    star = (materialize(_star_pairs(lists, percent), "jaccard-leaders").join(heads_a, "a").join(heads_b, "b")
            .select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b")))
    inside = (nodes.join(first.where("head <> tail"), "grp").where("sig <> head")
              .select(F.col("head").alias("a"), F.col("sig").alias("b")))
    star = materialize(_new_pairs(star.union(inside), pairs), "jaccard-star")
    pairs = pairs.union(star)
    links = materialize(links.union(_verify(docs, nodes, star, k, percent)), "jaccard-links")
    components = connected_components(links)
    several = first.where("head <> tail")
    heads = several.select("grp", "head")
    several = materialize(nodes.join(several, "grp", "left_semi").select("grp", "sig", "n"), "jaccard-sets-of-groups")
    for _ in range(HEAD_ROUNDS):
        heads, more = _head_pairs(several, heads, components)
        if heads.isEmpty():
            break
        more = materialize(_new_pairs(more, pairs), "jaccard-inside")
        links = materialize(links.union(_verify(docs, nodes, more, k, percent)), "jaccard-links")
        pairs = pairs.union(more)
        components = connected_components(links)
    return pairs, links, components, several


def ngram_jaccard_components(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT,
                             bits: int = COUNT_BITS) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_shingles, component_id)``,
    one row per input row.

    * Null, empty or word-free text: ``n_shingles`` 0, a component of its own.
    * One to four words: the whole sequence is the only shingle.
    * Repeated rows: each is returned; equal texts are in one component.
    * ``component_id`` is the smallest non-null ``doc_id`` of the component
      (null where all are null).  An empty table gives an empty result.
    * Only ``doc_id`` and ``text`` are read; other columns may have any name.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts, common = shingle_counts(docs, k, bits), NONE_COMMON
    pairs = links = spark.sql("select binary(null) as a, binary(null) as b where false")
    for order in range(ORDER_ROUNDS + 1):
        with recorded() as written:
            sets = materialize(document_sets(docs, counts, k, percent, common), "jaccard-sets")
            nodes = materialize(sets.where("n > 0").groupBy("grp", "sig").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n")), "jaccard-nodes")
            lists = materialize(posting_lists(sets, percent), "jaccard-lists")
        pairs, links, components, several = _first_components(docs, nodes, lists, pairs, links, k, percent)
        with recorded() as opened:
            members = materialize(_open_members(lists, nodes, several, components), "jaccard-mixed")
        more = _common_shingles(members, lists.count(), common) if order < ORDER_ROUNDS else None
        if more is None:
            break
        common = more
        remove(spark, written + opened)
    cross = materialize(_cross_pairs(members, pairs, percent), "jaccard-cross")
    links = links.union(_verify(docs, nodes, cross, k, percent))
    components = connected_components(links)

    of_set = nodes.select("sig", "doc").join(components.withColumnRenamed("node", "sig"), "sig", "left")
    of_set = materialize(of_set, "jaccard-components-of-sets")
    smallest = of_set.where("component is not null").groupBy("component").agg(F.min("doc").alias("component_id"))
    of_set = of_set.join(smallest, "component", "left").select("sig", F.coalesce("component_id", "doc").alias("component_id"))
    return (sets.select("doc_id", "n", "sig").join(of_set, "sig", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each component the document with the
    smallest id stays.  Rows that share an id are one document; rows with a
    null id stay."""
    from feedlens.llm.tables import drop_ids

    found = materialize(ngram_jaccard_components(docs), "jaccard-components")
    return drop_ids(docs, found.where("component_id <> doc_id").select("doc_id"))
