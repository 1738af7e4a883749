"""Theme discovery without a language model.

TF-IDF vectors of the masked review text are clustered with k-means for each
k in ``k_range``; the k with the best silhouette wins.  All rows take part in
every step, and all terms of a text count: they are hashed into ``FEATURES``
cells.  A theme is named by the terms that set its rows apart from the others'.

Each pass reads the rows once for all k: every task assigns its rows to the
nearest centres and adds them up, and its sums (one short vector a centre) are
added by centre.  Vectors are whole numbers (``UNIT`` is one), so sums are the
same in any order; first centres are chosen by a hash of the row.  The themes
therefore do not depend on how the input is partitioned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import TOKEN_SPLIT
from feedlens.operators.ordering import top_k_within
from feedlens.session import scratch_path, ship_package

K_RANGE = (3, 4, 5)
#: Cells into which terms are hashed; two terms in one cell count as one.
FEATURES = 2**12
#: Rows of smallest hash among which the first centres lie.
CANDIDATES = 64
NAME_TERMS = 3
#: One, in the whole numbers of which vectors consist.
UNIT = 2**20

SCHEMA = "review_id long, theme_id string, theme string, description string"
_CELLS = "_cells"


def default_stop_words() -> list[str]:
    return [w for lang in ("english", "german", "spanish", "french")
            for w in StopWordsRemover.loadDefaultStopWords(lang)]


def discover_themes(df: DataFrame, text_col: str = "text", seed: int = 42, k_range=K_RANGE, max_iter: int = 12,
                    stop_words: list[str] | None = None) -> DataFrame:
    """``review_id, theme_id, theme, description`` for every row.

    Rows without a term belong to the centre that is nearest to nothing.  An
    empty table gives no rows; one kind of row gives one theme."""
    spark = df.sparkSession
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), TOKEN_SPLIT), lambda t: t != "")
    stop = StopWordsRemover(inputCol="_words", outputCol="_terms",
                            stopWords=default_stop_words() if stop_words is None else stop_words)
    # Masking and tokenising is the expensive part: it runs once, and the term
    # arrays are written to the shared folder, as columns: what follows reads the
    # columns that it needs.
    ship_package(spark)
    cells = F.array_sort(F.transform("_terms", lambda t: F.pmod(F.xxhash64(t), F.lit(FEATURES)).cast("int")))
    terms = _written(stop.transform(df.select("review_id", words.alias("_words")))
                     .select("review_id", "_terms", cells.alias(_CELLS)), "theme-terms")
    n = terms.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    idf = np.log((n + 1) / (_document_frequencies(terms) + 1.0))
    # The passes read the vectors and no terms.
    vectors = _written(_with_vectors(terms, idf), "theme-vectors")
    model = _best_model(vectors.select("_vector", "_values"), _first_centres(terms, idf, seed, max(k_range)), k_range, max_iter)

    @F.arrow_udf("int")
    def prediction(vector: pa.Array, values: pa.Array) -> pa.Array:
        return pa.array(_nearest(*_read(vector, values), model).astype(np.int32))

    # Python sees the vectors alone; the terms stay where they are.
    rows = _written(vectors.select("review_id", "_terms", prediction("_vector", "_values").alias("prediction")), "theme-rows")
    named = _names(rows)
    return rows.join(F.broadcast(named), "prediction").select("review_id", "theme_id", "theme", "description")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- vectors

def _counts(cells: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, cell, count, rows) of a batch's lists of cells."""
    sizes = np.asarray(cells.value_lengths()).astype(np.int64)
    flat = np.repeat(np.arange(len(sizes)), sizes) * FEATURES + np.asarray(cells.flatten())
    pairs, counts = np.unique(flat, return_counts=True)
    return pairs // FEATURES, pairs % FEATURES, counts, len(sizes)


def _weighed(cells: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, cell, value, rows): the rows' sparse TF-IDF vectors of length ``UNIT``,
    each added up in the order of its cells."""
    row, cell, counts, rows = _counts(cells)
    weight = counts * idf[cell]
    length = np.sqrt(np.bincount(row, weights=weight * weight, minlength=rows))[row]
    value = np.divide(weight * UNIT, length, out=np.zeros(len(row)), where=length > 0)
    return row, cell, np.rint(value).astype(np.int64), rows


def _with_vectors(terms: DataFrame, idf: np.ndarray) -> DataFrame:
    """``review_id, _terms, _vector, _values``: the sparse vectors, computed once."""
    @F.arrow_udf("_vector array<int>, _values array<long>")
    def weigh(cells: pa.Array) -> pa.Array:
        row, cell, value, rows = _weighed(cells, idf)
        ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (cell.astype(np.int32), value)]
        return pa.StructArray.from_arrays(lists, names=["_vector", "_values"])

    return terms.select("review_id", "_terms", weigh(_CELLS).alias("_v")).select("review_id", "_terms", "_v._vector", "_v._values")


def _read(vector: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, cell, value, rows) of a batch's written vectors."""
    sizes = np.asarray(vector.value_lengths())
    return (np.repeat(np.arange(len(sizes)), sizes), np.asarray(vector.flatten()).astype(np.int64),
            np.asarray(values.flatten()), len(sizes))


def _dots(row: np.ndarray, cell: np.ndarray, value: np.ndarray, rows: int, vectors: np.ndarray) -> np.ndarray:
    """Product of each row with each of ``vectors``, added in the order of the cells."""
    value = value.astype(np.float64)
    return np.stack([np.bincount(row, weights=value * v[cell], minlength=rows) for v in vectors], axis=1)


def _nearest(row, cell, value, rows, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, the first of several.  Products and
    squares are whole numbers below 2**53, so the distances are exact."""
    squares = (centres * centres).sum(axis=1)
    return (squares - 2 * _dots(row, cell, value, rows, centres)).argmin(axis=1)


def _document_frequencies(terms: DataFrame) -> np.ndarray:
    def count(batches):
        found = np.zeros(FEATURES, np.int64)
        for batch in batches:
            found += np.bincount(_counts(batch.column(0))[1], minlength=FEATURES)
        yield _block(0, found)

    return _added(terms.select(_CELLS).mapInArrow(count, "part int, sums binary"), 1)[0]


def _block(part: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sums.astype(np.int64).tobytes()])],
                                      names=["part", "sums"])


def _added(blocks: DataFrame, parts: int) -> np.ndarray:
    """The tasks' sums added up by part: ``parts`` short vectors."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = np.frombuffer(sums, np.int64)
                total[part] = total[part] + sums if part in total else sums
        for part, sums in total.items():
            yield _block(part, sums)

    found = blocks.repartition(parts, "part").mapInArrow(add, "part int, sums binary").collect()
    found = {r.part: np.frombuffer(bytes(r.sums), np.int64) for r in found}
    return np.stack([found[j] for j in range(parts)])


# ---------------------------------------------------------------- k-means

def _first_centres(terms: DataFrame, idf: np.ndarray, seed: int, k: int) -> np.ndarray:
    """Up to ``k`` rows far from each other among those of smallest hash: the
    first of them, and each time the one whose nearest chosen row is farthest."""
    drawn = terms.select(_CELLS, F.xxhash64(F.lit(seed), _CELLS).alias("_draw"))
    # The draws first, which are narrow; then the cells of the chosen ones alone.
    draws = [r[0] for r in drawn.select("_draw").distinct().orderBy("_draw").limit(CANDIDATES).collect()]
    some = (drawn.where(F.col("_draw") <= draws[-1]).groupBy("_draw").agg(F.first(_CELLS).alias(_CELLS))
            .orderBy("_draw").collect())
    row, cell, value, rows = _weighed(pa.array([list(r[_CELLS]) for r in some], pa.list_(pa.int32())), idf)
    dense = np.zeros((rows, FEATURES), np.int64)
    dense[row, cell] = value
    chosen = [0]
    while len(chosen) < min(k, rows):
        far = np.min([((dense - dense[c]).astype(np.float64) ** 2).sum(axis=1) for c in chosen], axis=0)
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return dense[chosen]


def _best_model(vectors: DataFrame, first: np.ndarray, k_range, max_iter: int) -> np.ndarray:
    """Centres of the k with the best silhouette (the smaller k of equals)."""
    models = [first[:k] for k in sorted({min(k, len(first)) for k in k_range})]
    for _ in range(max_iter):
        sums = _cluster_sums(vectors, models)
        moved = [_means(s, old) for s, old in zip(sums, models)]
        if all((a == b).all() for a, b in zip(moved, models)):
            break
        models = moved
    scores = _silhouettes(vectors, models, _cluster_sums(vectors, models))
    return models[max(range(len(models)), key=lambda j: (scores[j], -j))]


def _means(sums: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Mean of each cluster; an empty one keeps its centre."""
    size = sums[:, -1:]
    return np.where(size > 0, np.floor_divide(sums[:, :FEATURES], np.maximum(size, 1)), old)


def _cluster_sums(vectors: DataFrame, models: list[np.ndarray]) -> list[np.ndarray]:
    """For each model and centre the sum of its rows' vectors, the number of its
    rows with a term, and the number of its rows."""
    def add(batches):
        sums = [np.zeros((len(m), FEATURES + 2), np.int64) for m in models]
        for batch in batches:
            row, cell, value, rows = _read(batch.column(0), batch.column(1))
            filled = np.bincount(row, minlength=rows) > 0
            for model, total in zip(models, sums):
                nearest = _nearest(row, cell, value, rows, model)
                at = np.bincount(nearest[row] * FEATURES + cell, weights=value, minlength=len(model) * FEATURES)
                total[:, :FEATURES] += at.astype(np.int64).reshape(len(model), FEATURES)
                total[:, -2] += np.bincount(nearest[filled], minlength=len(model))
                total[:, -1] += np.bincount(nearest, minlength=len(model))
        for j, centre in enumerate(np.concatenate(sums)):
            yield _block(j, centre)

    added = _added(vectors.mapInArrow(add, "part int, sums binary"), sum(map(len, models)))
    return np.split(added, np.cumsum([len(m) for m in models])[:-1])


def _silhouettes(vectors: DataFrame, models: list[np.ndarray], sums: list[np.ndarray]) -> list[float]:
    """Mean silhouette (squared Euclidean) of each model, below all others for
    a single cluster.

    A row's mean squared distance to a cluster follows from the cluster's sum
    and sizes: vectors have length one, or none.  Rows' values are rounded before
    they are added, so the sum is the same in any order."""
    def add(batches):
        total = np.zeros(len(models), np.int64)
        for batch in batches:
            row, cell, value, rows = _read(batch.column(0), batch.column(1))
            own = (np.bincount(row, minlength=rows) > 0).astype(np.float64)
            for j, (model, added) in enumerate(zip(models, sums)):
                used = added[:, -1] > 0
                if used.sum() < 2:
                    continue
                clusters, mine = added[used], (np.cumsum(used) - 1)[_nearest(row, cell, value, rows, model)]
                filled, size = (clusters[:, -c].astype(np.float64) for c in (2, 1))
                distance = own[:, None] * size + filled - 2 * _dots(row, cell, value, rows, clusters) / UNIT**2
                at = np.arange(rows), mine
                inside = distance[at] / np.maximum(size[mine] - 1, 1)
                mean = distance / size
                mean[at] = np.inf
                outside = mean.min(axis=1)
                most = np.maximum(inside, outside)
                found = np.where((size[mine] > 1) & (most > 0), (outside - inside) / np.where(most > 0, most, 1), 0)
                total[j] += np.rint(found * UNIT).astype(np.int64).sum()
        yield _block(0, total)

    found = _added(vectors.mapInArrow(add, "part int, sums binary"), 1)[0]
    return [t / s[:, -1].sum() if (s[:, -1] > 0).sum() > 1 else -np.inf for t, s in zip(found, sums)]


def _names(rows: DataFrame) -> DataFrame:
    """``prediction, theme_id, theme, description``: one row per cluster.

    A cluster's terms are ranked by the share of its rows that have the term
    minus the share of all other rows that have it (ties by term).  Both come
    from one hash aggregate of (cluster, term)."""
    spark = rows.sparkSession
    sizes = {r.prediction: r["count"] for r in rows.groupBy("prediction").count().collect()}  # at most k rows
    total = sum(sizes.values())
    per = (rows.select("prediction", F.explode(F.array_distinct("_terms")).alias("term"))
           .groupBy("term").pivot("prediction", sorted(sizes)).count().na.fill(0))
    ranked = None
    for c, size in sorted(sizes.items()):
        everywhere = sum((F.col(str(o)) for o in sizes), F.lit(0))
        apart = F.col(str(c)) / size - (everywhere - F.col(str(c))) / max(total - size, 1)
        one = per.where(F.col(str(c)) > 0).select(F.lit(c).alias("prediction"), "term", apart.alias("apart"))
        ranked = one if ranked is None else ranked.unionByName(one)
    top = top_k_within(ranked, ["prediction"], [F.col("apart").desc(), F.col("term")], NAME_TERMS)
    found: dict[int, list[str]] = {c: [] for c in sorted(sizes)}
    for r in top.orderBy("prediction", "rank").collect():  # at most k * NAME_TERMS rows
        found[r.prediction].append(r.term)
    names = [(c, f"theme_{i}", " / ".join(t) or f"cluster {i}", "Reviews using: " + ", ".join(t))
             for i, (c, t) in enumerate(found.items(), 1)]
    return spark.createDataFrame(names, "prediction int, theme_id string, theme string, description string")
