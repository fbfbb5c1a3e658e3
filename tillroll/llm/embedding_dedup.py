"""Embedding near-duplicates by inverted lists and product quantisation.

Vectors are compared on the unit sphere, where a cosine of ``least`` is a
distance of ``sqrt(2 - 2 * least)``. A coarse quantiser deals them into lists;
what is left over is coded per subspace. A query visits the lists that can
hold a neighbour, sums table entries for the codes there (asymmetric
distances) and computes exact cosines for what remains. Both quantisers are
fitted on a bounded sample; every vector is indexed and every vector queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import shuffle_partitions, stored
from tillroll.llm.components import connected_components, merge_labels

# Vectors on which both quantisers are fitted, and the most lists made of them.
SAMPLE, MOST_LISTS = 16_384, 1024
SUBSPACES, CODES, ROUNDS = 8, 64, 8
# Vectors of one list met by one block, and rows per group handed to one call.
BLOCK, GROUP_ROWS = 8_000, 50_000
# Queries whose tables are held at once.
QUERIES = 256


@dataclass(frozen=True)
class Quantiser:
    """Centroids, their mutual distances and per-subspace codebooks for one dimension."""

    centroids: np.ndarray
    codebooks: list[np.ndarray]
    apart: np.ndarray

    @property
    def cuts(self) -> np.ndarray:
        return np.cumsum([0, *(c.shape[1] for c in self.codebooks)])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        sizes = (x**2).sum(1)[:, None] + (self.centroids**2).sum(1)
        return np.maximum(sizes - 2 * x @ self.centroids.T, 0)

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the exact distance between each and its code."""
        codes, wrong = np.zeros((len(rest), len(self.codebooks)), "u1"), np.zeros(len(rest))
        for m, book in enumerate(self.codebooks):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            codes[:, m] = nearest(part, book)
            wrong += ((part - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(wrong)

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of query residuals to every code: query, subspace, code."""
        out = np.full((len(rest), len(self.codebooks), CODES), np.inf)
        for m, book in enumerate(self.codebooks):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            out[:, m, : len(book)] = ((part[:, None, :] - book[None]) ** 2).sum(2)
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centres after a fixed number of rounds from evenly spaced rows."""
    distinct = np.unique(x, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> Quantiser:
    centroids = k_means(sample, lists)
    rest = sample - centroids[nearest(sample, centroids)]
    dim = sample.shape[1]
    cuts = np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int)
    books = [k_means(rest[:, a:b], CODES) for a, b in zip(cuts, cuts[1:], strict=False)]
    sizes = (centroids**2).sum(1)
    apart = np.sqrt(np.maximum(sizes[:, None] + sizes - 2 * centroids @ centroids.T, 0))
    return Quantiser(centroids, books, apart)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows on the unit sphere; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def vectors_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8")


def valid_classes(vectors: DataFrame) -> DataFrame:
    """Distinct (label, vector) with ``cid``, size ``n`` and smallest ``rep`` id."""
    usable = vectors.filter(
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    )
    grouped = usable.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"))
    return stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def fit_quantisers(classes: DataFrame) -> dict[int, Quantiser]:
    """One quantiser per dimension from ``SAMPLE`` classes, picked by a hash of the vector."""
    n = classes.count()
    picked = classes.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).toPandas()["embedding"]
    lists = int(min(MOST_LISTS, max(1, round(n**0.5 / 2))))
    by_dim: dict[int, list] = {}
    for v in picked:
        by_dim.setdefault(len(v), []).append(v)
    return {d: fit(unit(np.array(v, "f8")), min(lists, max(1, len(v) // 16))) for d, v in by_dim.items()}


def visited(quantiser: Quantiser, x: np.ndarray, radius: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """The own list of each vector, and a mask of the lists it visits.

    A vector within ``radius`` of x lies in list c only if x is at most
    ``radius`` beyond the plane between its own centroid and c. ``slack`` 1
    visits all such lists and misses nothing. A neighbour's offset towards one
    given plane is a small part of its distance in many dimensions, hence the
    smaller default. Own and larger list numbers only: the other end of a link
    visits the rest.
    """
    d = quantiser.distances(x)
    own = d.argmin(1)
    apart = quantiser.apart[own]
    beyond = d - d[np.arange(len(x)), own][:, None]
    lists = np.arange(len(quantiser.centroids))
    mask = (beyond <= 2 * apart * radius * slack + 1e-9) & (lists[None] > own[:, None])
    mask[np.arange(len(x)), own] = True
    return own, mask


def compare_list(
    quantiser: Quantiser | None, held: pd.DataFrame, asks: pd.DataFrame, least: float, radius: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (query, holder) with an exact cosine of at least ``least``; each pair once."""
    y, x = (np.frombuffer(b"".join(p["vector"]), "<f8").reshape(len(p), -1) for p in (held, asks))
    own, ids, asked = held["own"].to_numpy(), held["cid"].to_numpy(), asks["cid"].to_numpy()
    uy, ux = unit(y), unit(x)
    sy, sx = np.sqrt((y**2).sum(1)), np.sqrt((x**2).sum(1))
    same = asks["own"].to_numpy() == own[0]
    if quantiser is not None:
        centre = quantiser.centroids[own[0]]
        codes, wrong = quantiser.encode(uy - centre)
    for at in range(0, len(x), QUERIES):
        rows = slice(at, at + QUERIES)
        may = ~(same[rows, None] & (asked[rows, None] >= ids[None]))
        if quantiser is not None:
            table = quantiser.tables(ux[rows] - centre)
            near = np.zeros(may.shape)
            for m in range(codes.shape[1]):
                near += table[:, m, codes[:, m]]
            may &= np.sqrt(near) <= radius + wrong[None] + 1e-9
        q, h = np.nonzero(may)
        q += at
        with np.errstate(all="ignore"):
            cosine = np.einsum("ij,ij->i", x[q], y[h]) / (sx[q] * sy[h])
            odd = ~np.isfinite(cosine) | (sx[q] * sy[h] < 1e-200)
        if odd.any():
            cosine[odd] = np.einsum("ij,ij->i", ux[q[odd]], uy[h[odd]])
        found = cosine >= least
        yield q[found], h[found]


def compare_group(pdf: pd.DataFrame, quantisers: dict[int, Quantiser], least: float, radius: float) -> pd.DataFrame:
    """Per vector its links found here and the root of a star that spans them."""
    nodes, node = np.unique(pdf["cid"].to_numpy(), return_inverse=True)
    links, labels = np.zeros(len(nodes), "i8"), np.arange(len(nodes))
    pdf = pdf.assign(node=node)
    for _, part in pdf.groupby(["label", "dim", "list", "held_in", "asked_in"], sort=False):
        asks_here = part["asks"].to_numpy()
        held, asks = part[~asks_here], part[asks_here]
        if not len(held) or not len(asks):
            continue
        a, b = asks["node"].to_numpy(), held["node"].to_numpy()
        na, nb = asks["n"].to_numpy(), held["n"].to_numpy()
        for q, h in compare_list(quantisers.get(int(part["dim"].iloc[0])), held, asks, least, radius):
            np.add.at(links, a[q], nb[h])
            np.add.at(links, b[h], na[q])
            merge_labels(labels, a[q], b[h])
    linked = np.flatnonzero(links)
    return pd.DataFrame({"cid": nodes[linked], "links": links[linked], "root": nodes[labels[linked]]})


def near_vectors(vectors: DataFrame, least: float = 0.98, slack: float = 0.6) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vec_id, embedding, label``.

    Rows with equal, non-null labels and a cosine of at least ``least`` are
    linked. Rows whose vector is null, empty, zero or holds a null or
    non-finite component, or whose label is null, link with nothing, and
    vectors of different lengths never link. Equal vectors are compared once
    and counted by their number, so a row that repeats k times has k - 1 links
    from that. A null ``vec_id`` counts as a link and never names a component
    unless all ids there are null. Other columns are ignored; an empty table
    gives an empty result.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
    )
    classes = valid_classes(rows)
    quantisers = fit_quantisers(classes)
    n_all = classes.count()
    groups = max(4 * shuffle_partitions(rows.sparkSession), n_all * 4 // GROUP_ROWS + 1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            pdf["dim"] = pdf["embedding"].map(len)
            for dim, part in pdf.groupby("dim"):
                for at in range(0, len(part), 1024):
                    some = part.iloc[at : at + 1024]
                    x = np.array(some["embedding"].tolist(), "f8")
                    quantiser = quantisers.get(int(dim))
                    if quantiser is None:
                        own, mask = np.zeros(len(x), int), np.ones((len(x), 1), bool)
                    else:
                        own, mask = visited(quantiser, unit(x), radius, slack)
                    who, where = np.nonzero(mask)
                    raw = [v.tobytes() for v in x.astype("<f8")]
                    both = np.concatenate([np.arange(len(x)), who])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some["label"].to_numpy()[both], pa.int64()),
                            pa.array(np.full(len(both), dim, "i4")),
                            pa.array(np.concatenate([own, where]).astype("i4")),
                            pa.array(np.arange(len(both)) >= len(x)),
                            pa.array(own[both].astype("i4")),
                            pa.array(some["cid"].to_numpy()[both]),
                            pa.array(some["n"].to_numpy()[both]),
                            pa.array([raw[i] for i in both], pa.binary()),
                        ],
                        names=["label", "dim", "list", "asks", "own", "cid", "n", "vector"],
                    )

    kind = "label long, dim int, list int, asks boolean, own int, cid long, n long, vector binary"
    # Labels become numbers so that any type of label will do.
    ranked = classes.select(F.xxhash64("label").alias("label"), "embedding", "cid", "n")
    indexed = stored(ranked.mapInArrow(index, kind), "inverted-lists")
    sizes = indexed.groupBy("label", "dim", "list").agg(
        F.count_if(~F.col("asks")).alias("held"), F.count_if("asks").alias("asked")
    )
    crowded = sizes.filter((F.col("held") > BLOCK) | (F.col("asked") > 4 * BLOCK))
    # At most one entry per label and list, each standing for over BLOCK rows.
    blocks = F.broadcast(
        crowded.select(
            "label", "dim", "list",
            F.ceil(F.col("held") / BLOCK).cast("int").alias("held_blocks"),
            F.ceil(F.col("asked") / (4 * BLOCK)).cast("int").alias("asked_blocks"),
        )
    )
    dealt = indexed.join(blocks, ["label", "dim", "list"], "left")
    mixed = F.xxhash64("cid")
    every = F.when(F.col("asks"), F.coalesce("held_blocks", F.lit(1))).otherwise(F.coalesce("asked_blocks", F.lit(1)))
    own_block = F.pmod(mixed, F.when(F.col("asks"), F.coalesce("asked_blocks", F.lit(1))).otherwise(F.coalesce("held_blocks", F.lit(1))))
    dealt = dealt.withColumn("other_in", F.explode(F.sequence(F.lit(0), every - 1))).withColumn("own_in", own_block.cast("int"))
    dealt = dealt.select(
        "label", "dim", "list", "asks", "own", "cid", "n", "vector",
        F.when(F.col("asks"), F.col("other_in")).otherwise(F.col("own_in")).alias("held_in"),
        F.when(F.col("asks"), F.col("own_in")).otherwise(F.col("other_in")).alias("asked_in"),
    )
    place = F.pmod(F.xxhash64("label", "dim", "list", "held_in", "asked_in"), F.lit(groups)).cast("int")
    found = dealt.withColumn("grp", place).groupBy("grp").applyInPandas(
        lambda pdf: compare_group(pdf, quantisers, least, radius), "cid long, links long, root long"
    )
    found = stored(found, "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups_of = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, "cid", "left").join(groups_of.withColumnRenamed("node", "cid"), "cid", "left")
    named = stored(
        named.select(
            "label", "embedding", "rep",
            F.coalesce("component", "cid").alias("component"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "vector-groups",
    )
    least_id = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labelled = named.join(least_id, "component").select("label", "embedding", "n_links", "component_id")
    usable = F.col("n_links").isNotNull()
    joined = rows.join(labelled, ["label", "embedding"], "left")
    component = F.when(usable, F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
