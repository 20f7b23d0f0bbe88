"""Near-duplicate vectors by an exact metric range join.

Cosine of at least 0.98 is a distance of at most r = 0.2 between unit vectors. Within a label
a few vectors are drawn as pivots and every vector belongs to the cell of its nearest one.
It visits another cell j as well unless the distances rule out that anything near it lives
there: by the triangle inequality if d(x, p_j) > d(x, p_home) + 2r or d(x, p_j) > R_j + r
(R_j: the farthest member of j from its pivot), and in Euclidean space if x is farther than
r from the plane between the two pivots (pivots closer than ``_APART`` have no plane that could
be told from rounding; only the triangle inequality rules out then). Cells are then joined independently: everything in
a cell, members and visitors, with the cell's members. Every vector has one home, so each
link of a vector is counted exactly once, and the pivots only decide how much work is saved.

Equal vectors are one row with a count, so copies never meet each other. Large cells are cut
into blocks of members and of visitors that meet in tasks of bounded size. A task returns a
number of links per vector and, for the components, the smallest vector each is connected to
inside the task: no pairs.

Defined results: rows whose vector or label is null, whose vector is empty or zero or holds a
null or non-finite component, and rows with null id have 0 links and are their own component.
Vectors of different length are not compared. Rows that share an id count as separate
vectors and as one node. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.components import smallest_reachable
from usagelens.llm.common import ship_package
from usagelens.session import stage

COSINE = 0.98
#: Members a cell should have, and the most pivots a label gets.
CELL = 256
MAX_PIVOTS = 1024
#: Members or visitors of a cell that meet in one task; vectors placed in one task.
BLOCK = 1024
PLACE = 4096
#: Distances are compared with this much to spare, so that rounding never loses a link. A
#: squared distance is off by some 1e-14, so one near 0 by up to 1e-7, and a plane between
#: pivots that are ``_APART`` by 1e-8.
_SPARE = 1e-6
_APART = 1e-3


def unit_vectors(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, dims, unit, node) of every row; unit and node null where it cannot be
    linked. ``unit`` holds doubles, ``node`` names label and vector: equal ones are one node."""

    def run(batches):
        for batch in batches:
            vectors, labels = batch.column(1), batch.column(2).to_pylist()
            lengths = [0 if x is None else x for x in
                       pa.compute.list_value_length(vectors).to_pylist()]
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.r_[0, np.cumsum(lengths)].astype(np.int64)
            units, names = [], []
            for i, length in enumerate(lengths):
                own = values[starts[i]:starts[i] + length]
                unit = None
                if length and labels[i] is not None and np.isfinite(own).all() and own.any():
                    own = own / np.abs(own).max()  # no overflow in the squares
                    unit = (own / np.sqrt((own * own).sum())).tobytes()
                units.append(unit)
                names.append(None if unit is None else xxhash.xxh3_128_hexdigest(
                    unit + str(labels[i]).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(lengths, pa.int32()),
                 pa.array(units, pa.binary()), pa.array(names, pa.string())],
                names=["id", "label", "dims", "unit", "node"])

    kinds = {n: rows.schema[n].dataType.simpleString() for n in (key, label)}
    return rows.select(key, F.col(vector).cast("array<double>"), label).mapInArrow(
        run, f"id {kinds[key]}, label {kinds[label]}, dims int, unit binary, node string")


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def place(vectors: DataFrame, radius: float) -> DataFrame:
    """Cells of all vectors (label, dims, node, unit, copies): their columns and (cell, home).
    A vector has one row with ``home`` and one for every cell it visits."""
    space = ["label", "dims"]
    sizes = stage(vectors.groupBy(*space).agg(F.count("*").alias("size")), "label-sizes")
    sized = vectors.join(sizes, space).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("size") / PLACE)).cast("int"))
    # A vector is a pivot with a probability that gives the label the wanted number of them.
    wanted = F.least(F.ceil(F.col("size") / CELL), F.lit(MAX_PIVOTS))
    chance = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    pivots = stage(sized.where((wanted > 1) & (chance < wanted / F.col("size"))).select(
        *space, "size", F.col("unit").alias("pivot")).distinct(), "pivots")
    per_part = pivots.withColumn("part", F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("size") / PLACE).cast("int") - 1))).select(*space, "part", "pivot")
    columns = f"label {vectors.schema['label'].dataType.simpleString()}, dims int, node string, unit binary, copies long"

    def nearest(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        """Home and distances; pivots in the order of their bytes in every task."""
        if rows.empty:
            return pd.DataFrame(columns=["label", "dims", "node", "unit", "copies", "home", "far"])
        rows = rows[["label", "dims", "node", "unit", "copies"]].copy()
        if own.empty:
            return rows.assign(home=0, far=0.0)
        away = _distances(_matrix(rows["unit"]), _matrix(sorted(own["pivot"])))
        home = away.argmin(axis=1)
        return rows.assign(home=home, far=away[np.arange(len(rows)), home])

    homes = stage(sized.groupBy(*space, "part").cogroup(per_part.groupBy(*space, "part")).applyInPandas(
        nearest, columns + ", home int, far double"), "homes")
    reach = homes.groupBy(*space, "home").agg(F.max("far").alias("reach")).groupBy(*space).agg(
        F.map_from_entries(F.collect_list(F.struct("home", "reach"))).alias("reaches"))  # <= MAX_PIVOTS
    around = stage(pivots.groupBy(*space).agg(F.array_sort(F.collect_set("pivot")).alias("pivots"),
                                              F.first("size").alias("size")).join(reach, space), "around")

    def visits(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or own.empty:
            return pd.DataFrame(columns=["label", "dims", "node", "unit", "copies", "cell"])
        pivots = _matrix(own["pivots"].iloc[0])
        reaches = np.full(len(pivots), -np.inf)
        for cell, far in dict(own["reaches"].iloc[0]).items():
            reaches[cell] = far
        home = rows["home"].to_numpy()
        away = _distances(_matrix(rows["unit"]), pivots)
        mine = away[np.arange(len(rows)), home][:, None]
        between = _distances(pivots, pivots)[home]
        plane = np.where(between > _APART,
                         (away ** 2 - mine ** 2) / (2.0 * np.maximum(between, _APART)), -np.inf)
        near = ((away <= mine + 2 * radius + _SPARE) & (away <= reaches + radius + _SPARE)
                & (plane <= radius + _SPARE))
        near[np.arange(len(rows)), home] = False
        row, cell = np.nonzero(near)
        return rows.iloc[row][["label", "dims", "node", "unit", "copies"]].assign(cell=cell)

    placed = homes.join(sizes, space).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("size") / PLACE)).cast("int"))
    per_part = around.withColumn("part", F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("size") / PLACE).cast("int") - 1)))
    visiting = placed.groupBy(*space, "part").cogroup(per_part.groupBy(*space, "part")).applyInPandas(
        visits, columns + ", cell int")
    return homes.select(*space, "node", "unit", "copies", F.col("home").alias("cell"),
                        F.lit(True).alias("home")).unionByName(
        visiting.withColumn("home", F.lit(False)))


def _meet(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of a block of a cell's vectors with a block of its members."""
    members, others = rows[rows["member"]], rows[~rows["member"]]
    if members.empty or others.empty:
        return pd.DataFrame(columns=["node", "links", "root"])
    linked = _matrix(others["unit"]) @ _matrix(members["unit"]).T >= cosine
    ids = pd.Index(pd.unique(rows["node"])).sort_values()
    a, b = ids.get_indexer(others["node"]), ids.get_indexer(members["node"])
    links = linked @ members["copies"].to_numpy(np.int64)
    i, j = np.nonzero(linked)
    left, right = a[i], b[j]
    root = np.arange(len(ids))
    while True:  # the smallest vector connected inside this task
        before = root.copy()
        np.minimum.at(root, left, before[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if (root == before).all():
            break
    touched = np.unique(np.r_[left, right])
    return pd.concat([
        pd.DataFrame({"node": others["node"].to_numpy(), "links": links, "root": ids[root[a]]}),
        pd.DataFrame({"node": ids[touched], "links": 0, "root": ids[root[touched]]})])


def range_join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, links, root) rows: links to be added up by node, and connections node - root."""
    cell = ["label", "dims", "cell"]
    placed = stage(place(vectors, float(np.sqrt(2.0 - 2.0 * cosine))), "cells")
    sizes = stage(placed.groupBy(*cell).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("member_blocks"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("member_blocks > 0"), "cell-sizes")
    sized = placed.join(sizes, cell)
    as_member = sized.where("home").select(
        *cell, "node", "unit", "copies", F.lit(True).alias("member"),
        F.pmod(F.xxhash64("node", F.lit(3)), F.col("member_blocks")).cast("int").alias("mb"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("ob"))
    as_other = sized.select(
        *cell, "node", "unit", "copies", F.lit(False).alias("member"),
        F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)).alias("mb"),
        F.pmod(F.xxhash64("node", F.lit(4)), F.col("blocks")).cast("int").alias("ob"))
    return as_member.unionByName(as_other).groupBy(*cell, "mb", "ob").applyInPandas(
        lambda rows: _meet(rows, cosine), "node string, links long, root string")


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    ship_package(rows.sparkSession)
    found = stage(unit_vectors(rows, key, vector, label), "unit-vectors")
    linkable = found.where(F.col("node").isNotNull() & F.col("id").isNotNull())
    classes = stage(linkable.groupBy("node").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("dims").alias("dims"), F.first("unit").alias("unit")), "classes")
    met = stage(range_join(classes.drop("first"), cosine), "met")
    totals = met.groupBy("node").agg(F.sum("links").alias("links"))
    # One id with several vectors joins their classes, each to the smallest.
    repeated = linkable.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where(
        "a != last").select("id", "a")
    several = linkable.select("id", F.col("node").alias("b")).join(repeated, "id").where(
        "a != b").select("a", "b").distinct()
    edges = met.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")).distinct()
    components = smallest_reachable(edges.unionByName(several))
    joined = stage(classes.select("node", "first").join(totals, "node").join(components, "node", "left").select(
        "node", "first", "links", F.coalesce("component", "node").alias("component")), "joined")
    smallest = stage(joined.groupBy("component").agg(F.min("first").alias("smallest")), "smallest")
    answers = stage(joined.join(smallest, "component").select("node", "links", "smallest"), "answers")
    own = F.col("links").isNotNull() & F.col("id").isNotNull()
    return found.select("id", "node").join(answers, "node", "left").select(
        F.col("id").alias(key),
        F.when(own, F.col("links") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(own, F.col("smallest")).otherwise(F.col("id")).alias("component_id")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id")))
