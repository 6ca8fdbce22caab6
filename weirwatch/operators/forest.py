"""Isolation forest (Liu, Ting, Zhou 2008) trained and applied on Spark.

A tree needs a sub-sample of 256 rows. One pass over the table keeps, for every
tree, the rows with the least draws; a draw is a linear function of the row
key's digest, so neither a random generator nor the number of rows decides, and
parts are merged in any order. Cuts come from digests of tree and node, and
model inputs are rounded, so that sums added up in another order give the same
forest. One task grows each tree; scoring runs in Arrow batches with the node
arrays broadcast, whose size depends on the number of trees alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.fixed_values import (
    FOREST_SAMPLE,
    FOREST_SEED,
    FOREST_TREES,
    MODEL_NAME,
    REQUEST_FEATURES,
)
from weirwatch.operators.whole_quantiles import whole_quantiles
from weirwatch.session import materialize

EULER_GAMMA = 0.5772156649015329
# Draws are residues of a prime: products of two 28-bit parts stay below 2^63.
_PRIME = (1 << 31) - 1
# Rows of a tree meet in so many groups first, so that no task gets a tree's rows of all partitions.
_MERGE_GROUPS = 64
# Model inputs and scores keep so many decimals: more than any sum's order can change.
INPUT_DIGITS, SCORE_DIGITS = 6, 10
NODE_SCHEMA = (
    "tree_id INT, node_id INT, feature INT, threshold DOUBLE, left_id INT, right_id INT, "
    "size INT, depth INT"
)
KEYS = ("window_start", "ip_hash")


@dataclass(frozen=True)
class Forest:
    """A trained model: its node table, its parameter table and its version."""

    nodes: DataFrame
    params: DataFrame
    model_version: str


def parse_contamination(value: str | float) -> str | float:
    """``auto`` or a share in (0, 0.5]."""
    if value == "auto":
        return "auto"
    share = float(value)
    if not 0.0 < share <= 0.5:
        raise ValueError("contamination must be 'auto' or a share in (0, 0.5]")
    return share


def feature_medians(features: DataFrame, columns: list[str] = REQUEST_FEATURES) -> DataFrame:
    """Exact median per feature as ``(feature, median)``, nulls ignored; a feature without a value is absent.

    All features share the same few passes over the table, which run at once.
    """
    found = whole_quantiles(features, {c: (c, 0.5, "interpolated") for c in columns})
    rows = [(c, m) for c, m in found.items() if m is not None]
    return features.sparkSession.createDataFrame(rows, "feature STRING, median DOUBLE")


def _inputs(columns: list[str], medians: dict[str, float]) -> list[Column]:
    """Model inputs: rounded doubles in model order, gaps filled with medians."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c, 0.0)))) for c in columns]
    return [F.round(c, INPUT_DIGITS) for c in filled]


def _parts(text: str, sizes: tuple[int, ...]) -> list[int]:
    """Numbers of so many hex digits each from the digest of a text."""
    digits, out = hashlib.sha256(text.encode()).hexdigest(), []
    for size in sizes:
        out.append(int(digits[:size], 16))
        digits = digits[size:]
    return out


def _key_numbers(features: DataFrame, keys: tuple[str, ...], seed: int) -> list[Column]:
    """Two 28-bit numbers and a tie-breaker from a row's key; times count in microseconds."""
    kinds = dict(features.dtypes)
    texts = [F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k) for k in keys]
    texts = [F.coalesce(t.cast("string"), F.lit("")) for t in texts]
    digest = F.sha2(F.concat_ws("|", *texts, F.lit(str(seed))), 256)
    return [F.conv(F.substring(digest, at, size), 16, 10).cast("long") for at, size in ((1, 7), (8, 7), (15, 15))]


def _least_draws(seed: int, trees: int, sample: int):
    """The function that keeps, of one partition, every tree's ``sample`` rows with the least draws.

    Memory is bounded by trees x sample draws and the rows that they name.
    """
    coefficients = np.array([_parts(f"{seed}|tree|{t}", (7,) * 6) for t in range(trees)], dtype=np.int64)
    a1, b1, c1, a2, b2, c2 = (coefficients[:, [i]] for i in range(6))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.full(trees, np.iinfo(np.int64).max)
        tree, draw, tie, at = (np.zeros(0, dtype=np.int64) for _ in range(4))
        rows = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h1, h2, ties, *inputs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            data = np.column_stack(inputs)
            draws = (a1 * h1 + b1 * h2 + c1) % _PRIME * (_PRIME + 1) + (a2 * h1 + b2 * h2 + c2) % _PRIME
            limit = bound
            if batch.num_rows > sample:
                limit = np.minimum(bound, np.partition(draws, sample - 1, axis=1)[:, sample - 1])
            new_tree, new_row = np.nonzero(draws <= limit[:, None])
            if len(new_tree) == 0:
                continue
            held = 0 if rows is None else len(rows)
            rows = data if rows is None else np.concatenate([rows, data])
            tree = np.concatenate([tree, new_tree])
            draw = np.concatenate([draw, draws[new_tree, new_row]])
            tie = np.concatenate([tie, ties[new_row]])
            at = np.concatenate([at, new_row + held])
            order = np.lexsort((tie, draw, tree))
            sizes = np.bincount(tree, minlength=trees)
            first = np.cumsum(sizes) - sizes
            place = np.arange(len(order)) - np.repeat(first, sizes)
            order = order[place < sample]
            tree, draw, tie, at = tree[order], draw[order], tie[order], at[order]
            full = np.flatnonzero(sizes >= sample)
            ends = np.cumsum(np.minimum(sizes, sample)) - 1
            bound[full] = draw[ends[full]]
            used, at = np.unique(at, return_inverse=True)
            rows = rows[used]
        for t in np.unique(tree):
            mine = tree == t
            x = rows[at[mine]]
            offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
            columns = [pa.array(tree[mine], pa.int32()), pa.array(draw[mine]), pa.array(tie[mine]), lists]
            yield pa.RecordBatch.from_arrays(columns, ["tree_id", "draw", "tie", "x"])

    return keep


def subsamples(
    features: DataFrame, inputs: list[Column], keys: tuple[str, ...], trees: int, sample: int, seed: int
) -> DataFrame:
    """``tree_id, draw, tie, x``: the ``sample`` rows with the least draws of every tree.

    One pass, whatever the size: each partition keeps its least rows, and those
    of all partitions are merged in two steps. A table of fewer rows gives all
    of them to every tree.
    """
    named = [c.alias(f"h{i}") for i, c in enumerate(_key_numbers(features, keys, seed))]
    named += [c.alias(f"x{i}") for i, c in enumerate(inputs)]
    drawn = features.select(*named).mapInArrow(
        _least_draws(seed, trees, sample), "tree_id INT, draw BIGINT, tie BIGINT, x ARRAY<DOUBLE>"
    )
    drawn = drawn.withColumn("_group", F.pmod("tie", F.lit(_MERGE_GROUPS)))
    for group in (["tree_id", "_group"], ["tree_id"]):
        nearest = W.partitionBy(*group).orderBy("draw", "tie")
        drawn = drawn.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= sample)
    return drawn.select("tree_id", "draw", "tie", "x")


def _grower(seed: int):
    """The function that grows one tree from its rows; node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        rows = rows.sort_values(["draw", "tie"], kind="stable")
        data = np.array(rows["x"].tolist(), dtype=np.float64)
        limit = int(np.ceil(np.log2(max(len(data), 2))))
        nodes: list[list] = []
        todo = [(np.arange(len(data)), 0, 0)]
        while todo:
            index, depth, node = todo.pop()
            part = data[index]
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            nodes.append([tree, node, -1, 0.0, -1, -1, len(index), depth])
            if depth >= limit or len(index) <= 1 or len(usable) == 0:
                continue
            which, place = _parts(f"{seed}|node|{tree}|{node}", (7, 13))
            feature = int(usable[which % len(usable)])
            cut = low[feature] + place / 2.0**52 * (high[feature] - low[feature])
            # Rounding must not push the cut onto the maximum: both sides need rows.
            cut = float(cut if cut < high[feature] else low[feature])
            goes_left = part[:, feature] <= cut
            nodes[-1][2:6] = [feature, cut, 2 * node + 1, 2 * node + 2]
            todo.append((index[~goes_left], depth + 1, 2 * node + 2))
            todo.append((index[goes_left], depth + 1, 2 * node + 1))
        names = ["tree_id", "node_id", "feature", "threshold", "left_id", "right_id", "size", "depth"]
        return pd.DataFrame(nodes, columns=names)

    return grow


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    big = np.where(n > 2, n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def fit_forest(
    features: DataFrame,
    model_version: str,
    contamination: str | float = "auto",
    trees: int = FOREST_TREES,
    sample: int = FOREST_SAMPLE,
    seed: int = FOREST_SEED,
    columns: list[str] = REQUEST_FEATURES,
    keys: tuple[str, ...] = KEYS,
) -> Forest:
    """Train on a feature table with unique keys.

    ``features`` is read several times; pass a stored table. Splits are drawn
    between the minimum and maximum of a feature, so standardising the
    features first would not change the distribution of scores and is left
    out. A table without rows is an error.
    """
    contamination = parse_contamination(contamination)
    spark = features.sparkSession
    medians = {r.feature: r.median for r in feature_medians(features, columns).collect()}
    rows = subsamples(features, _inputs(columns, medians), keys, trees, sample, seed)
    grown = rows.groupBy("tree_id").applyInPandas(_grower(seed), NODE_SCHEMA)
    # A forest has at most trees * (2 * sample - 1) nodes whatever the table.
    table = grown.toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    if table.empty:
        raise ValueError("no feature rows to train on")
    size = int(table["size"].max())
    nodes = spark.createDataFrame(table, NODE_SCHEMA)
    params = spark.createDataFrame(
        [
            (
                model_version,
                MODEL_NAME,
                trees,
                size,
                seed,
                str(contamination),
                -0.5,
                columns,
                {c: float(medians.get(c, 0.0)) for c in columns},
            )
        ],
        "model_version STRING, model_name STRING, trees INT, sample INT, seed INT, "
        "contamination STRING, score_offset DOUBLE, feature_columns ARRAY<STRING>, "
        "medians MAP<STRING, DOUBLE>",
    )
    forest = Forest(nodes, params, model_version)
    if contamination != "auto":
        training = raw_scores(features, forest).select(F.col("raw_decision_score").alias("s"))
        training = materialize(training, "training-scores")
        cut = whole_quantiles(training, {"cut": ("s", float(contamination), "interpolated")})["cut"]
        params = params.withColumn("score_offset", F.col("score_offset") + F.lit(float(cut)))
        forest = Forest(nodes, params, model_version)
    return forest


def _with_places(nodes: pd.DataFrame) -> pd.DataFrame:
    """Nodes by tree and id with their place in the whole table, their children's and their tree's first."""
    nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    ids = nodes["tree_id"].to_numpy(np.int64) << 32
    known = ids + nodes["node_id"].to_numpy()
    here = np.arange(len(nodes))
    leaf = (nodes["feature"] < 0).to_numpy()
    children = {s: np.where(leaf, here, np.searchsorted(known, ids + nodes[f"{s}_id"].to_numpy())) for s in ("left", "right")}
    first = np.searchsorted(known, ids)
    length = nodes["depth"].to_numpy() + expected_path(nodes["size"].to_numpy())
    return nodes.assign(**children, first=first, leaf=leaf, length=length)


def _node_arrays(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """All trees in one set of arrays; a leaf points to itself."""
    nodes = _with_places(nodes)
    return {
        "roots": nodes["first"].unique().astype(np.int32),
        "feature": np.where(nodes["leaf"], 0, nodes["feature"]).astype(np.int32),
        "cut": np.where(nodes["leaf"], np.inf, nodes["threshold"]),
        "left": nodes["left"].to_numpy(np.int32),
        "right": nodes["right"].to_numpy(np.int32),
        "length": nodes["length"].to_numpy(),
        "levels": np.int32(nodes["depth"].max()),
    }


def raw_scores(features: DataFrame, forest: Forest) -> DataFrame:
    """Add ``raw_decision_score``: below zero for outliers."""
    spark = features.sparkSession
    params = forest.params.first()
    arrays = spark.sparkContext.broadcast(_node_arrays(forest.nodes.toPandas()))
    norm = float(expected_path(np.array([params.sample]))[0]) or 1.0
    offset = float(params.score_offset)

    @F.pandas_udf("double")
    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        a = arrays.value
        for batch in batches:
            x = batch.to_numpy(dtype=np.float64)
            if len(x) == 0:
                yield pd.Series([], dtype="float64")
                continue
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for root in a["roots"]:
                at = np.full(len(x), root, dtype=np.int32)
                for _ in range(a["levels"]):
                    goes_left = x[rows, a["feature"][at]] <= a["cut"][at]
                    at = np.where(goes_left, a["left"][at], a["right"][at])
                total += a["length"][at]
            mean = total / len(a["roots"])
            yield pd.Series(-np.power(2.0, -mean / norm) - offset)

    inputs = _inputs(list(params.feature_columns), dict(params.medians))
    inputs = F.struct(*[c.alias(f"x{i}") for i, c in enumerate(inputs)])
    return features.withColumn("raw_decision_score", F.round(decide(inputs), SCORE_DIGITS))


def raw_scores_in_catalyst(features: DataFrame, forest: Forest) -> DataFrame:
    """The same scores from Column expressions only, as a cross-check.

    Each tree becomes an array of nodes and a row walks it with ``aggregate``.
    Slower than :func:`raw_scores`; meant for tests.
    """
    params = forest.params.first()
    nodes = _with_places(forest.nodes.toPandas())
    trees = []
    for _, tree in nodes.groupby("tree_id"):
        trees.append(
            F.array(
                *[
                    F.struct(
                        F.lit(int(n.feature)).alias("f"),
                        F.lit(float(n.threshold)).alias("t"),
                        F.lit(int(n.left - n.first)).alias("l"),
                        F.lit(int(n.right - n.first)).alias("r"),
                        F.lit(float(n.length)).alias("len"),
                    )
                    for n in tree.itertuples()
                ]
            )
        )
    x = F.array(*_inputs(list(params.feature_columns), dict(params.medians)))
    steps = F.sequence(F.lit(1), F.lit(int(nodes["depth"].max()) or 1))

    def walk(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            down = F.when(F.get(x, node["f"]) <= node["t"], node["l"]).otherwise(node["r"])
            return F.when(node["f"] < 0, at).otherwise(down)

        return F.get(tree, F.aggregate(steps, F.lit(0), step))["len"]

    total = walk(trees[0])
    for tree in trees[1:]:
        total = total + walk(tree)
    norm = float(expected_path(np.array([params.sample]))[0]) or 1.0
    raw = -F.pow(F.lit(2.0), -(total / len(trees)) / norm) - F.lit(float(params.score_offset))
    return features.withColumn("raw_decision_score", F.round(raw, SCORE_DIGITS))


def save_forest(forest: Forest, path: str) -> None:
    """Store node and parameter tables below ``path``, one folder per version."""
    for name, table in (("nodes", forest.nodes), ("params", forest.params)):
        table.coalesce(1).write.mode("overwrite").parquet(
            f"{path}/{name}/model_version={forest.model_version}"
        )


def load_forest(spark: SparkSession, path: str, model_version: str) -> Forest:
    """A stored model; a version that was never stored is an error."""
    where = f"model_version={model_version}"
    try:
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes/{where}")
        params = spark.read.parquet(f"{path}/params/{where}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no stored model {model_version} in {path}") from error
    if "model_version" not in params.columns:
        params = params.withColumn("model_version", F.lit(model_version))
    return Forest(nodes, params, model_version)


def score_forest(features: DataFrame, forest: Forest, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Score table of a feature table: raw and scaled score, flag and rank."""
    from weirwatch.operators.ranking import normalize_and_rank
    from weirwatch.session import materialize

    raw = raw_scores(features, forest).select(*keys, "raw_decision_score")
    # Bounds and ranks read the raw scores again; walk the trees only once.
    ranked = normalize_and_rank(materialize(raw, "raw-scores"), keys=keys)
    return ranked.select(
        *keys,
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(forest.model_version).alias("model_version"),
        "anomaly_score",
        "raw_decision_score",
        (F.col("raw_decision_score") < 0).alias("is_anomaly"),
        "anomaly_rank",
    )
