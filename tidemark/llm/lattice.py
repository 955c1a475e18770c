"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected at random to eight dimensions, once per table, and decoded to the nearest point of
the E8 lattice. A vector lies in its own cell and is also looked for in the neighbouring cells whose points are
closest. Cell mates are candidates; cosines are verified in double precision. Links then give components, and
links are counted exactly inside each component in blocks, so pairs of a large group are never written out.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import cut, read
from .components import components
from .shingles import mix

#: Cells of at most so many members are joined on ids; larger ones, and components, are compared in blocks.
SMALL_CELL, BLOCK = 48, 512


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0...) in any two places, and (+-1/2)^8 with evenly many minuses."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def _nearest_d8(y):
    p = np.rint(y)
    odd = np.flatnonzero(p.sum(1) % 2)
    off = y[odd] - p[odd]
    worst = np.abs(off).argmax(1)
    p[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return p


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8 = D8 and D8 + 1/2 for each row."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def _cell(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A 64-bit key of lattice points (..., 8) and a salt per row."""
    with np.errstate(over="ignore"):
        h = salt
        for k in range(8):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + (2 * points[..., k]).astype(np.int64).view(np.uint64))
    return h


def cells(unit: np.ndarray, group: np.ndarray, tables: int, probes: int, scale: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n, tables) and neighbouring cells (n, tables, probes) of unit vectors; group keeps labels apart."""
    rng, near = np.random.default_rng(seed), roots()
    own, more = [], []
    for t in range(tables):
        y = unit @ (rng.normal(0, scale, (unit.shape[1], 8)))
        p = nearest_e8(y)
        with np.errstate(over="ignore"):
            salt = mix(group + np.uint64(t + 1))
        own.append(_cell(p, salt))
        best = np.argsort(-((y - p) @ near.T), axis=1, kind="stable")[:, :probes]
        more.append(np.stack([_cell(p + near[best[:, k]], salt) for k in range(probes)], axis=1))
    return np.stack(own, 1), np.stack(more, 1)


def hit_rate(scale: float, cosine: float, probes: int, samples: int = 4_000, seed: int = 3) -> float:
    """The share of pairs at that cosine that one table brings together, in either direction. Projections of such a
    pair are normal, with that correlation, whatever the vectors are; so it is simulated."""
    rng, near = np.random.default_rng(seed), roots()
    x = rng.normal(0, scale, (samples, 8))
    y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * rng.normal(0, scale, (samples, 8))
    p, q = nearest_e8(x), nearest_e8(y)
    met = np.zeros(samples, bool)
    for a, home, other in ((x, p, q), (y, q, p)):
        best = np.argpartition(-((a - home) @ near.T), probes - 1, axis=1)[:, :probes]
        met |= (home == other).all(1) | ((home[:, None, :] + near[best]) == other[:, None, :]).all(2).any(1)
    return float(met.mean())


def plan_tables(rows: int, cosine: float, probes: int, recall: float) -> tuple[float, int]:
    """(scale, tables) of least work for labels of so many rows: enough tables for that recall at the threshold.

    A cell has volume 1, so two unrelated vectors share one with probability (2 sqrt(pi) scale)^-8: larger scales keep
    cells small as the table grows, and need more tables."""
    best = (np.inf, 1.0, 1)
    for scale in (1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0):
        p = hit_rate(scale, cosine, probes)
        tables = 1 if p >= recall else int(np.ceil(np.log(1 - recall) / np.log1p(-max(p, 1e-4))))
        mates = rows * (2 * np.sqrt(np.pi) * scale) ** -8.0
        plan = (tables * (1 + probes) * (1 + mates), scale, tables)
        if plan[0] > best[0]:
            break
        best = plan
    return best[1:]


def _features(batches, tables, probes, scale):
    for pdf in batches:
        rows = []
        for i, (label, v) in enumerate(zip(pdf["label"], pdf["v"])):
            if label is None or pd.isna(label) or v is None or not len(v):
                continue
            x = np.array([np.nan if c is None else c for c in v], dtype=np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top  # so that neither tiny nor huge components leave the range of squares
                rows.append((i, x / np.linalg.norm(x)))
        out = pd.DataFrame({"rid": pdf["rid"], "vec_id": pdf["vec_id"].astype("Int64"), "label": pdf["label"].astype("Int64")})
        digests, units, own, more = ([None] * len(pdf) for _ in range(4))
        for width in {len(u) for _, u in rows}:
            at = [i for i, u in rows if len(u) == width]
            u = np.stack([u for _, u in rows if len(u) == width])
            labels = out["label"].to_numpy()[at].astype(np.int64).view(np.uint64)
            with np.errstate(over="ignore"):
                a, b = cells(u, mix(labels * np.uint64(1_000_003) + np.uint64(width)), tables, probes, scale)
            a, b = a.view(np.int64), b.view(np.int64)
            for k, i in enumerate(at):
                digests[i] = hashlib.blake2b(np.asarray(pdf["v"].iloc[i], np.float64).tobytes(), digest_size=16).digest()
                units[i], own[i], more[i] = u[k], a[k], b[k].ravel()
        yield out.assign(digest=digests, unit=units, own=own, more=more)


def _pairs_in_small_cells(cell_rows: DataFrame) -> DataFrame:
    home, mates = cell_rows.where("home"), cell_rows
    pairs = home.alias("x").join(mates.alias("y"), (F.col("x.cell") == F.col("y.cell")) & (F.col("x.cid") != F.col("y.cid")))
    return pairs.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def _blocked(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Each row with the block pairs (i <= j) of its group that it takes part in; block is its own block."""
    n = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("blocks", n).withColumn("block", F.pmod(F.xxhash64("cid", F.lit(5)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(F.col(group).alias("g"), F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "cid", "unit", *(["weight"] if "weight" in rows.columns else []))


def _like(pdf: pd.DataFrame, cosine: float) -> np.ndarray:
    """Which rows of a block pair link, each pair in the block pair that is its own; all units have one length."""
    u = np.stack(pdf["unit"].to_numpy())
    s = u @ u.T >= cosine
    if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
        b = pdf["block"].to_numpy()
        s &= b[:, None] != b
    np.fill_diagonal(s, False)
    return s


def lattice_components(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, tables: int | None = None, probes: int = 8, scale: float | None = None, recall: float = 0.9999) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept. Vectors of different labels or lengths never link.

    Null, empty and zero vectors, those with null or non-finite components, and those without a label link with
    nothing. Equal vectors are searched once and count as linked with one another; rows that repeat an id count
    as vectors of their own. A null id can't name a component: its row has the smallest id it links to, and is kept.
    Unless given, scale and tables follow from the rows of the largest label and the recall of pairs at the threshold.
    """
    if tables is None or scale is None:
        most = vectors.groupBy(label).count().agg(F.max("count")).first()[0] or 0
        scale, tables = plan_tables(most, cosine, probes, recall)
    src = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    feats = src.mapInPandas(lambda b: _features(b, tables, probes, scale), "rid long, vec_id long, label long, digest binary, unit array<double>, own array<long>, more array<long>")
    feats = cut(feats, "vectors")
    key = ["label", "digest"]
    classes = feats.where("digest is not null").groupBy(*key).agg(F.min("rid").alias("cid"), F.min("vec_id").alias("least_id"), F.count("*").alias("weight"))
    classes = cut(classes, "classes")
    distinct = feats.select(F.col("rid").alias("cid"), "unit", "own", "more").join(classes.select("cid", "weight", "least_id"), "cid")
    units = distinct.select("cid", "unit", "weight")

    home = distinct.select("cid", F.explode("own").alias("cell"), F.lit(True).alias("home"))
    mates = home.union(distinct.select("cid", F.explode("more").alias("cell"), F.lit(False).alias("home")))
    sizes = mates.groupBy("cell").agg(F.count("*").alias("size"), F.max("home").alias("any")).where("any and size > 1").drop("any")
    placed = cut(mates.join(sizes, "cell"), "cells")
    few = _pairs_in_small_cells(placed.where(F.col("size") <= SMALL_CELL))

    @F.pandas_udf("double")
    def cosines(x: pd.Series, y: pd.Series) -> pd.Series:
        out, widths = np.zeros(len(x)), x.map(len).to_numpy()
        for width in np.unique(widths):  # mates have one length, the pairs of a batch may not
            at = np.flatnonzero(widths == width)
            out[at] = np.einsum("ij,ij->i", np.stack(x.iloc[at]), np.stack(y.iloc[at]))
        return pd.Series(out)

    left = few.join(units.select(F.col("cid").alias("a"), F.col("unit").alias("x")), "a")
    both = left.join(units.select(F.col("cid").alias("b"), F.col("unit").alias("y")), "b")
    links = both.where(cosines("x", "y") >= cosine).select("a", "b")

    many = placed.where(F.col("size") > SMALL_CELL).select("cell", "cid", "size").join(units.select("cid", "unit"), "cid")

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links that span the components of a block pair, one per row at most."""
        s, cid = _like(pdf, cosine), pdf["cid"].to_numpy()
        todo, out = set(range(len(cid))), []
        while todo:
            stack = [todo.pop()]
            while stack:
                x = stack.pop()
                for y in np.flatnonzero(s[x]):
                    if y in todo:
                        todo.remove(y)
                        stack.append(y)
                        out.append((cid[x], cid[y]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    spanning = _blocked(many, "cell", "size").groupBy("g", "i", "j").applyInPandas(forest, "a long, b long")
    named = cut(components(links.union(spanning)), "components")

    # exact counts: every link lies inside one component; small components share a group
    member = units.join(named, units.cid == named.id).select("cid", "unit", "weight", "component")
    size = named.groupBy("component").agg(F.count("*").alias("size"))
    member = cut(member.join(size, "component"), "members")
    total = member.where(F.col("size") <= BLOCK // 2).count()
    bins = max(1, total // BLOCK)
    small = member.where(F.col("size") <= BLOCK // 2).select(F.pmod(F.xxhash64("component"), F.lit(bins)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "cid", "unit", "weight", "component")
    large = _blocked(member.where(F.col("size") > BLOCK // 2), "component", "size")

    def counts(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cid": pdf["cid"], "n": _like(pdf, cosine) @ pdf["weight"].to_numpy()})

    def counts_shared(pdf: pd.DataFrame) -> pd.DataFrame:
        """Counts in a group of several components, whose members have one label and one length only within each."""
        parts = []
        for _, rows in pdf.groupby(pdf["unit"].map(len)):
            c = rows["component"].to_numpy()
            parts.append(pd.DataFrame({"cid": rows["cid"], "n": (_like(rows, cosine) & (c[:, None] == c)) @ rows["weight"].to_numpy()}))
        return pd.concat(parts)

    n = "cid long, n long"
    counted = small.groupBy("g", "i", "j").applyInPandas(counts_shared, n).union(large.groupBy("g", "i", "j").applyInPandas(counts, n))
    counted = counted.groupBy("cid").agg(F.sum("n").alias("n"))
    least = classes.join(named, classes.cid == named.id).groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = named.join(least, "component").select(F.col("id").alias("cid"), "component_id")
    per_class = classes.join(counted, "cid", "left").join(linked, "cid", "left").select(*key, "weight", "n", "least_id", "component_id")
    out = feats.select("vec_id", *key).join(per_class, key, "left")
    n_links = F.when(F.col("digest").isNull(), 0).otherwise(F.col("weight") - 1 + F.coalesce("n", F.lit(0)))
    comp = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.coalesce("component_id", "least_id"))
    return out.select(F.col("vec_id").alias(id), n_links.cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))


def op1_lattice(spark, sf_dir):
    """Links and components of all embeddings at cosine 0.98 within a label."""
    return lattice_components(read(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_dot_product(a.v, b.v) / a.n / b.n >= 0.98),
r AS (WITH RECURSIVE reach(id, to_id) AS (SELECT a, b FROM l UNION SELECT reach.id, l.b FROM reach JOIN l ON l.a = reach.to_id)
      SELECT id, min(to_id) AS m FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(r.m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(r.m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN r ON r.id = vec_id
"""
