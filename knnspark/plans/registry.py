"""Registered queries over the driver's ``embeddings`` table and their DuckDB oracles.

Every entry reads the whole table (searches: queries = the rows whose id is divisible by 20, or by 10 where ``TENTH``
says so, base = all rows;
operators without a query side: all rows) and returns a DataFrame whose column names and types match the oracle SQL.  Distances are rounded to 6 places
on both sides (D15); ordering ties are always broken by id (D14).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knnspark.functions import distance as V
from knnspark.functions import stats as S
from knnspark.functions.hashing import double_array, lsh_coefficients
from knnspark.operators import cluster as K
from knnspark.operators import evaluate as M
from knnspark.operators import exact
from knnspark.operators import hypercube as H
from knnspark.operators import ivfflat as IVF
from knnspark.operators import lsh as LSH
from knnspark.operators import pivot as PIVOT
from knnspark.operators import pq as PQ
from knnspark.plans import api as API
from knnspark.plans import oracle as O
from knnspark.session import scratch_path
from knnspark.sources import binary as B
from knnspark.sources import sink as SINK
from knnspark.sources.vectors import (QUERY_EVERY, TENTH, as_queries, canonical, fixture_split, others, read_embeddings, validate_vectors,
                                       whole_table)

# Fixture parameters (FIXTURES.md §1 / SURVEY §7.4).
N = 5
R = 1.2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), 6))
    return df


# --------------------------------------------------------------------------- exact search


def _knn_sql(metric: str) -> str:
    return f"""WITH {O.SPLIT},
pairs AS (SELECT q.qid, b.id, {O.dist('q.qv', 'b.v', metric)} AS dist FROM queries q, base b)
{O.topn('pairs', N)}"""


def _range_sql(metric: str, radius: float) -> str:
    return f"""WITH {O.SPLIT},
pairs AS (SELECT q.qid, b.id, {O.dist('q.qv', 'b.v', metric)} AS dist FROM queries q, base b)
SELECT qid, id, round(dist, 6) AS dist FROM pairs WHERE dist <= {radius}"""


@register("knn_l2", O.tenths(_knn_sql("l2")))
def q_knn_l2(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(exact.knn(base, queries, N, "l2"), "dist")


@register("knn_l1", O.tenths(_knn_sql("l1")))
def q_knn_l1(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(exact.knn(base, queries, N, "l1"), "dist")


@register("range_l2", O.tenths(_range_sql("l2", R)))
def q_range_l2(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(exact.range_search(base, queries, R, "l2"), "dist")


R_L1 = 8.0     # L1 distances on the fixture are ~8x the L2 ones


@register("range_l1", O.tenths(_range_sql("l1", R_L1)))
def q_range_l1(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(exact.range_search(base, queries, R_L1, "l1"), "dist")


# The same searches over a pivot index, which skips blocks and rows by the triangle inequality.


def _pivot_search(spark, sf_dir, metric, radius=None):
    base, queries = fixture_split(spark, sf_dir)
    index = PIVOT.build(base, metric=metric, block_rows=PIVOT_ROWS)
    found = PIVOT.knn(index, queries, N) if radius is None else PIVOT.range_search(index, queries, radius)
    return _r6(found, "dist")


PIVOT_ROWS = 1 << 16


@register("pivot_knn_l2", _knn_sql("l2"))
def q_pivot_knn_l2(spark, sf_dir):
    return _pivot_search(spark, sf_dir, "l2")


@register("pivot_knn_l1", _knn_sql("l1"))
def q_pivot_knn_l1(spark, sf_dir):
    return _pivot_search(spark, sf_dir, "l1")


@register("pivot_range_l2", _range_sql("l2", R))
def q_pivot_range_l2(spark, sf_dir):
    return _pivot_search(spark, sf_dir, "l2", R)


@register("pivot_range_l1", _range_sql("l1", R_L1))
def q_pivot_range_l1(spark, sf_dir):
    return _pivot_search(spark, sf_dir, "l1", R_L1)


_NESTED_SQL = f"""WITH {O.TENTHS},
pairs AS (SELECT q.qid, b.id, {O.dist('q.qv', 'b.v')} AS dist FROM queries q, base b),
nb AS (SELECT qid, string_agg(printf('%d:%.6f', id, dist), ';' ORDER BY rank) AS neighbors FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM pairs) t
  WHERE rank <= {N} GROUP BY qid),
rg AS (SELECT qid, string_agg(printf('%d:%.6f', id, dist), ';' ORDER BY dist, id) AS hits
  FROM pairs WHERE dist <= {R} GROUP BY qid)
SELECT nb.qid, nb.neighbors, coalesce(rg.hits, '') AS hits, (SELECT count(*) FROM pairs p
  WHERE p.qid = nb.qid AND p.dist <= {R})::BIGINT AS n_hits
FROM nb LEFT JOIN rg ON nb.qid = rg.qid"""


@register("knn_nested", _NESTED_SQL)
def q_knn_nested(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    neighbors, hits = exact.knn_and_range(base, queries, N, R, "l2")
    nested = exact.nested_result(neighbors, hits)
    fmt = lambda arr: F.concat_ws(";", F.transform(arr, lambda s: F.format_string("%d:%.6f", s["id"], s["dist"])))
    return nested.select("qid", fmt("neighbors").alias("neighbors"), fmt("range").alias("hits"),
                         F.size("range").cast("bigint").alias("n_hits"))


# --------------------------------------------------------------------------- vector functions


NPROBE = 3
PQ_M = 16


def _label_centroids(base):
    return K.label_median_matrix(base)


@register("dim_mean", O.whole(f"""WITH {O.SPLIT}
SELECT label, dim::INTEGER AS dim, round(avg(x), 6) AS mean FROM (
  SELECT label, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM base) e
GROUP BY label, dim"""))
def q_dim_mean(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(S.dim_means(base, ["label"]), "mean")


@register("dim_median", O.whole(f"""WITH {O.SPLIT}
SELECT label, dim::INTEGER AS dim, round(median(x), 6) AS median FROM (
  SELECT label, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM base) e
GROUP BY label, dim"""))
def q_dim_median(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(S.dim_medians(base, ["label"]), "median")


@register("validate_vectors", """SELECT count(*)::BIGINT AS n_rows,
  sum(CASE WHEN embedding IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_null,
  min(len(embedding))::INTEGER AS min_dim, max(len(embedding))::INTEGER AS max_dim,
  sum(CASE WHEN list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x))) THEN 1 ELSE 0 END)::BIGINT
    AS n_bad_values,
  sum(CASE WHEN embedding IS NOT NULL AND len(embedding) <> 64 THEN 1 ELSE 0 END)::BIGINT AS n_wrong_dim
FROM embeddings""")
def q_validate(spark, sf_dir):
    emb = read_embeddings(spark, sf_dir)
    return validate_vectors(emb.select(F.col("embedding").alias("v")), "v", expected_dim=64)


@register("centroids", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT cid, (generate_subscripts(c, 1) - 1)::INTEGER AS dim, round(unnest(c), 6) AS c FROM cent"""))
def q_centroids(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    cents = K.label_medians(base)
    return cents.select("cid", F.posexplode("c").alias("dim", "c")).withColumn("c", F.round("c", 6))


_ASSIGN_SQL = f"""WITH {O.SPLIT}, {O.cent()}
SELECT id, cid, round(dist, 6) AS dist, cid2, round(dist2, 6) AS dist2 FROM asg"""


@register("assign", O.whole(_ASSIGN_SQL))
def q_assign(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(K.assign(base, _label_centroids(base)), "dist", "dist2")


@register("second_nearest", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT id, cid2, round(dist2, 6) AS dist2 FROM asg"""))
def q_second_nearest(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(K.assign(base, _label_centroids(base)).select("id", "cid2", "dist2"), "dist2")


@register("cluster_members", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT cid, count(*)::BIGINT AS n, min(id) AS min_id, max(id) AS max_id FROM asg GROUP BY cid"""))
def q_cluster_members(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return K.cluster_sizes(K.assign(base, _label_centroids(base)))


@register("silhouette_fast", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT cid, count(*)::BIGINT AS n, round(avg(
  CASE WHEN dist2 IS NULL THEN 1.0 WHEN greatest(dist, dist2) > 0 THEN (dist2 - dist) / greatest(dist, dist2)
       ELSE 0.0 END), 6) AS silhouette
FROM asg GROUP BY ROLLUP (cid)"""))
def q_silhouette_fast(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(K.silhouette_fast(K.assign(base, _label_centroids(base))), "silhouette")


@register("silhouette_full", O.whole(f"""WITH {O.SPLIT}, {O.cent()},
pts AS (SELECT asg.id, asg.cid, asg.cid2, b.v FROM asg JOIN base b ON b.id = asg.id),
sa AS (SELECT p.id, avg({O.dist('p.v', 'o.v')}) AS a FROM pts p JOIN pts o ON o.cid = p.cid AND o.id <> p.id
       GROUP BY p.id),
sb AS (SELECT p.id, avg({O.dist('p.v', 'o.v')}) AS b FROM pts p JOIN pts o ON o.cid = p.cid2 GROUP BY p.id),
s AS (SELECT p.id, p.cid,
        CASE WHEN sa.a IS NULL OR sb.b IS NULL THEN 0.0
             WHEN greatest(sa.a, sb.b) > 0 THEN (sb.b - sa.a) / greatest(sa.a, sb.b) ELSE 0.0 END AS s
      FROM pts p LEFT JOIN sa ON sa.id = p.id LEFT JOIN sb ON sb.id = p.id)
SELECT cid, count(*)::BIGINT AS n, round(avg(s), 6) AS silhouette FROM s GROUP BY ROLLUP (cid)"""))
def q_silhouette_full(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _r6(K.silhouette_full(base, K.assign(base, _label_centroids(base), carry=("v",))), "silhouette")


def _with_centroid(base):
    """``(id, v, c)``: every vector beside its nearest centroid (a checked matrix, so a bounded broadcast)."""
    cids, C = _label_centroids(base)
    cents = K.centroids_frame(base.sparkSession, cids, C)
    return K.assign(base, (cids, C), carry=("v",)).select("id", "v", "cid").join(F.broadcast(cents), "cid")


@register("squared_l2", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT b.id, round({O.sqdist('b.v', 'c.c')}, 6) AS sq FROM base b JOIN asg a ON a.id = b.id JOIN cent c ON c.cid = a.cid"""))
def q_squared_l2(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    j = _with_centroid(base)
    return j.select("id", F.round(V.squared_l2("v", "c"), 6).alias("sq"))


@register("residuals", O.whole(f"""WITH {O.SPLIT}, {O.cent()}
SELECT id, (generate_subscripts(r, 1) - 1)::INTEGER AS dim, round(unnest(r), 6) AS r FROM (
  SELECT b.id, list_transform(list_zip(b.v, c.c), lambda p: p[1] - p[2]) AS r
  FROM base b JOIN asg a ON a.id = b.id JOIN cent c ON c.cid = a.cid) t"""))
def q_residuals(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    j = _with_centroid(base)
    return (j.select("id", F.posexplode(V.residual("v", "c")).alias("dim", "r"))
            .withColumn("r", F.round("r", 6)))


@register("subvectors", O.whole(f"""WITH {O.SPLIT}
SELECT id, m::INTEGER AS m, round(sub[1], 6) AS first, round(list_sum(list_transform(sub, lambda x: x * x)), 6) AS ssq
FROM (SELECT id, unnest(generate_series(0, {PQ_M} - 1)) AS m,
             unnest(list_transform(generate_series(0, {PQ_M} - 1), lambda i: v[i * 4 + 1 : i * 4 + 4])) AS sub
      FROM base) t"""))
def q_subvectors(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    parts = base.select("id", F.posexplode(V.subvectors("v", PQ_M, 64 // PQ_M)).alias("m", "sub"))
    ssq = F.aggregate("sub", F.lit(0.0), lambda s, x: s + x * x)
    return parts.select("id", "m", F.round(F.col("sub")[0], 6).alias("first"), F.round(ssq, 6).alias("ssq"))


# --------------------------------------------------------------------------- IVFFlat


def _ivf_index(spark, sf_dir, every=QUERY_EVERY):
    base, queries = fixture_split(spark, sf_dir, every)
    return IVF.build_ivfflat(base, _label_centroids(base)), base, queries


@register("ivf_probes", f"""WITH {O.TENTHS}, {O.cent()}, {O.probes(NPROBE)}
SELECT qid, prank::INTEGER AS prank, cid, round(cdist, 6) AS cdist FROM probes""")
def q_ivf_probes(spark, sf_dir):
    index, _, queries = _ivf_index(spark, sf_dir, TENTH)
    return _r6(IVF.probes(index, queries, NPROBE).drop("qv"), "cdist")


_IVF_CANDS = f"""{O.SPLIT}, {O.cent()}, {O.probes(NPROBE)},
lists AS (SELECT a.cid, b.id, b.v FROM asg a JOIN base b ON b.id = a.id),
cands AS (SELECT p.qid, l.id, {O.dist('p.qv', 'l.v')} AS dist FROM probes p JOIN lists l ON l.cid = p.cid)"""


_IVF_KNN_SQL = f"WITH {_IVF_CANDS}\n{O.topn('cands', N)}"


@register("ivfflat_knn", O.tenths(_IVF_KNN_SQL))
def q_ivfflat_knn(spark, sf_dir):
    index, _, queries = _ivf_index(spark, sf_dir, TENTH)
    return _r6(IVF.search(index, queries, N, NPROBE), "dist")


@register("ivfflat_range", O.tenths(f"WITH {_IVF_CANDS}\nSELECT qid, id, round(dist, 6) AS dist FROM cands WHERE dist <= {R}"))
def q_ivfflat_range(spark, sf_dir):
    index, _, queries = _ivf_index(spark, sf_dir, TENTH)
    return _r6(IVF.range_search(index, queries, R, NPROBE), "dist")


# --------------------------------------------------------------------------- evaluation

# A query's own row is no neighbour in evaluations: its distance 0 would be every first distance.
_EVAL_CTES = f"""{_IVF_CANDS}, {O.other_pairs()},
{O.ranked('truth', 'pairs', N)},
{O.ranked('approx', '(SELECT * FROM cands WHERE id <> qid)', N)},
{O.eval_per_query(N)}"""


def _ivf_vs_exact(spark, sf_dir):
    index, base, queries = _ivf_index(spark, sf_dir)
    return others(IVF.search(index, queries, N + 1, NPROBE), N), others(exact.knn(base, queries, N + 1), N), queries


@register("average_af", f"WITH {_EVAL_CTES}\nSELECT round(avg(af), 6) AS average_af FROM pq")
def q_average_af(spark, sf_dir):
    approx, truth, queries = _ivf_vs_exact(spark, sf_dir)
    return _r6(M.summary(approx, truth, queries, N, "ivfflat").select("average_af"), "average_af")


@register("recall_at_n", f"WITH {_EVAL_CTES}\nSELECT round(avg(recall), 6) AS recall_at_n FROM pq")
def q_recall_at_n(spark, sf_dir):
    approx, truth, queries = _ivf_vs_exact(spark, sf_dir)
    return _r6(M.summary(approx, truth, queries, N, "ivfflat").select("recall_at_n"), "recall_at_n")


@register("truth_compare", f"""WITH {_EVAL_CTES}
SELECT a.qid, a.rank::INTEGER AS rank, a.id, round(a.dist, 6) AS dist, round(coalesce(t.dist, a.dist), 6) AS true_dist
FROM approx a LEFT JOIN truth t ON t.qid = a.qid AND t.rank = a.rank""")
def q_truth_compare(spark, sf_dir):
    approx, truth, _ = _ivf_vs_exact(spark, sf_dir)
    return _r6(M.truth_compare(approx, truth), "dist", "true_dist")


# --------------------------------------------------------------------------- LSH


DIM = 64
LSH_PARAMS = LSH.LSHParams(k=4, L=5, w=4.0, seed=1)
LSH_MODEL = LSH.draw_lsh(LSH_PARAMS, DIM)

_LSH_CTES = f"""{O.SPLIT},
{O.lsh_buckets_cte('bb', 'base', 'id', 'v', LSH_MODEL)},
{O.lsh_buckets_cte('qb', 'queries', 'qid', 'qv', LSH_MODEL)},
cands AS (SELECT DISTINCT qb.qid, bb.id FROM qb JOIN bb ON bb.t = qb.t AND bb.bucket = qb.bucket),
lpairs AS (SELECT c.qid, c.id, {O.dist('q.qv', 'b.v')} AS dist
           FROM cands c JOIN queries q ON q.qid = c.qid JOIN base b ON b.id = c.id)"""


@register("lsh_buckets", O.whole(f"WITH {_LSH_CTES}\nSELECT t, bucket, id FROM bb"))
def q_lsh_buckets(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return LSH.build_index(LSH_MODEL, base)


@register("lsh_candidates", f"WITH {_LSH_CTES}\nSELECT qid, id FROM cands")
def q_lsh_candidates(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    return LSH.candidates(LSH_MODEL, LSH.build_index(LSH_MODEL, base), queries)


_LSH_KNN_SQL = f"WITH {_LSH_CTES}\n{O.topn('lpairs', N)}"


@register("lsh_knn", O.tenths(_LSH_KNN_SQL))
def q_lsh_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(LSH.search(LSH_MODEL, base, queries, N), "dist")


@register("lsh_range", f"WITH {_LSH_CTES}\nSELECT qid, id, round(dist, 6) AS dist FROM lpairs WHERE dist <= {R}")
def q_lsh_range(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    return _r6(LSH.range_search(LSH_MODEL, base, queries, R), "dist")


# --------------------------------------------------------------------------- hypercube

CUBE_PARAMS = H.CubeParams(kproj=7, w=4.0, max_candidates=0, probes=8, seed=1)
CUBE_MODEL = H.draw_cube(CUBE_PARAMS, DIM)
CUBE_CAP = 50
CUBE_MODEL_CAPPED = H.CubeModel(H.CubeParams(kproj=7, w=4.0, max_candidates=CUBE_CAP, probes=8, seed=1),
                                CUBE_MODEL.P, CUBE_MODEL.t)
_MASKS = H.probe_masks(CUBE_PARAMS.kproj, CUBE_PARAMS.probes)

_CUBE_CTES = f"""{O.SPLIT},
{O.cube_codes_cte('bcode', 'base', 'id', 'v', CUBE_MODEL)},
{O.cube_codes_cte('qcode', 'queries', 'qid', 'qv', CUBE_MODEL)},
qprobe AS (SELECT q.qid, mk.prank::INTEGER AS prank, xor(q.code, mk.mask) AS code FROM qcode q, {O.masks_values(_MASKS)}),
cpairs AS (SELECT p.qid, b.id, p.prank FROM qprobe p JOIN bcode b ON b.code = p.code),
capped AS (SELECT qid, id, prank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY prank, id) AS k FROM cpairs) t WHERE k <= {CUBE_CAP}),
cdists AS (SELECT c.qid, c.id, {O.dist('q.qv', 'b.v')} AS dist FROM cpairs c
           JOIN queries q ON q.qid = c.qid JOIN base b ON b.id = c.id),
cdists_capped AS (SELECT c.qid, c.id, {O.dist('q.qv', 'b.v')} AS dist FROM capped c
           JOIN queries q ON q.qid = c.qid JOIN base b ON b.id = c.id)"""


@register("cube_codes", O.whole(f"WITH {_CUBE_CTES}\nSELECT id, code FROM bcode"))
def q_cube_codes(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return H.build_index(CUBE_MODEL, base).select("id", "code")


@register("cube_probes", O.whole(f"WITH {_CUBE_CTES}\nSELECT qid, prank, code FROM qprobe"))
def q_cube_probes(spark, sf_dir):
    queries = as_queries(whole_table(spark, sf_dir))
    return H.query_probes(CUBE_MODEL, queries)


@register("cube_candidates", O.tenths(f"WITH {_CUBE_CTES}\nSELECT qid, id, prank FROM capped"))
def q_cube_candidates(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return H.candidates(CUBE_MODEL_CAPPED, H.build_index(CUBE_MODEL_CAPPED, base), queries)


_CUBE_KNN_SQL = f"WITH {_CUBE_CTES}\n{O.topn('cdists', N)}"
_CUBE_CAPPED_SQL = f"WITH {_CUBE_CTES}\n{O.topn('cdists_capped', N)}"
_CUBE_RANGE_SQL = f"WITH {_CUBE_CTES}\nSELECT qid, id, round(dist, 6) AS dist FROM cdists WHERE dist <= {R}"


@register("cube_knn", O.tenths(_CUBE_KNN_SQL))
def q_cube_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(H.search(CUBE_MODEL, base, queries, N), "dist")


@register("cube_knn_capped", O.tenths(_CUBE_CAPPED_SQL))
def q_cube_knn_capped(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(H.search(CUBE_MODEL_CAPPED, base, queries, N), "dist")


@register("cube_range", O.tenths(_CUBE_RANGE_SQL))
def q_cube_range(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    return _r6(H.range_search(CUBE_MODEL, base, queries, R), "dist")


@register("dot_products", O.whole(f"""WITH {O.SPLIT},
{O.cube_codes_cte('bcode', 'base', 'id', 'v', CUBE_MODEL)}
SELECT b.id, cp.i::INTEGER AS i, round({O.dot('b.v', 'cp.p')}, 6) AS dot FROM base b, bcode_p cp"""))
def q_dot_products(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    proj = F.expr("array(" + ", ".join(double_array(row) for row in CUBE_MODEL.P) + ")")
    return (base.select("id", "v", F.posexplode(proj).alias("i", "p"))
            .select("id", "i", F.round(V.dot("v", "p"), 6).alias("dot")))


# --------------------------------------------------------------------------- training

TRAIN_K = 10
TRAIN_ITERS = 50    # the round limit; training stops before it by the stop rule
TRAIN_PARAMS = K.KMediansParams(k=TRAIN_K, metric="l2", seed=1, max_iter=TRAIN_ITERS, tol_changes=1)
_TRAIN = O.train_ctes(TRAIN_K, TRAIN_ITERS, 1, "l2")


def _sample(base):
    n = int(np.floor(np.sqrt(base.count())))
    return K.training_sample(base.select("id", "v"), n, 1)


@register("train_sample", O.whole(f"WITH {O.SPLIT}, {_TRAIN}\nSELECT id FROM s"))
def q_train_sample(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    return _sample(base).select("id")


@register("kmeanspp_seeds", O.whole(f"WITH {O.SPLIT}, {_TRAIN}\nSELECT cid::INTEGER AS cid, id FROM seeds"))
def q_kmeanspp_seeds(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    sample = _sample(base).checkpoint(eager=True)
    cids, _, ids = K.kmeanspp_seeds(sample, TRAIN_K, "l2", 1, with_ids=True)
    chosen = spark.createDataFrame([(int(c), int(i)) for c, i in zip(cids, ids)], "cid int, id bigint")
    # the chosen ids are checked against the sample table they were drawn from
    return chosen.join(sample.select("id"), "id").select("cid", "id")


def _centroid_rows(spark, cids, C):
    return (K.centroids_frame(spark, cids, C)
            .select("cid", F.posexplode("c").alias("dim", "c")).withColumn("c", F.round("c", 6)))


@register("kmedians_step", O.whole(f"""WITH {O.SPLIT}, {_TRAIN}
SELECT cid, (generate_subscripts(c, 1) - 1)::INTEGER AS dim, round(unnest(c), 6) AS c FROM cen1"""))
def q_kmedians_step(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    sample = _sample(base).checkpoint(eager=True)
    cids, C = K.kmeanspp_seeds(sample, TRAIN_K, "l2", 1)
    _, _, (cids, C) = K.kmedians_step(sample, cids, C, "l2", None)
    return _centroid_rows(spark, cids, C)


@register("kmedians_fit", O.whole(f"""WITH {O.SPLIT}, {_TRAIN}
SELECT cid, (generate_subscripts(c, 1) - 1)::INTEGER AS dim, round(unnest(c), 6) AS c FROM cen{TRAIN_ITERS}"""))
def q_kmedians_fit(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    cids, C, _ = K.kmedians_fit(base, TRAIN_PARAMS)
    return _centroid_rows(spark, cids, C)


@register("ivfflat_trained_knn", f"""WITH {O.TENTHS}, {_TRAIN},
tcent AS (SELECT cid, c FROM cen{TRAIN_ITERS}),
tasg AS (SELECT id, cid FROM (
  SELECT b.id, c.cid, row_number() OVER (PARTITION BY b.id ORDER BY {O.dist('b.v', 'c.c')}, c.cid) AS r
  FROM base b, tcent c) t WHERE r = 1),
{O.probes(NPROBE, cents='tcent')},
tcands AS (SELECT p.qid, b.id, {O.dist('p.qv', 'b.v')} AS dist
           FROM probes p JOIN tasg a ON a.cid = p.cid JOIN base b ON b.id = a.id)
{O.topn('tcands', N)}""")
def q_ivfflat_trained_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    index = IVF.build_ivfflat(base, None, TRAIN_PARAMS)
    return _r6(IVF.search(index, queries, N, NPROBE), "dist")


# --------------------------------------------------------------------------- IVFPQ


PQ_NBITS = 4
PQ_ITERS = 20
PQ_PARAMS = PQ.PQParams(m=PQ_M, nbits=PQ_NBITS, nprobe=NPROBE, seed=1, metric="l2", train_iters=PQ_ITERS)
_PQ = f"""{O.SPLIT}, {O.cent()},
{O.pq_ctes(PQ_M, 1 << PQ_NBITS, DIM // PQ_M, PQ_ITERS, NPROBE, 1)}"""


def _pq_index(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    return PQ.build_ivfpq(base, PQ_PARAMS, _label_centroids(base)), base, queries


@register("pq_train", O.whole(f"""WITH {_PQ}
SELECT m, h, (generate_subscripts(cw, 1) - 1)::INTEGER AS dim, round(unnest(cw), 6) AS cw FROM cbf"""))
def q_pq_train(spark, sf_dir):
    index = PQ.build_ivfpq(base := whole_table(spark, sf_dir), PQ_PARAMS, _label_centroids(base))
    return (PQ.codebook_table(spark, index).select("m", "h", F.posexplode("cw").alias("dim", "cw"))
            .withColumn("cw", F.round("cw", 6)))


@register("pq_encode", O.whole(f"""WITH {_PQ}
SELECT a.cid, e.id, e.m, e.code::INTEGER AS code FROM enc e JOIN asg a ON a.id = e.id"""))
def q_pq_encode(spark, sf_dir):
    index = PQ.build_ivfpq(base := whole_table(spark, sf_dir), PQ_PARAMS, _label_centroids(base))
    return index.codes.select("cid", "id", F.posexplode("codes").alias("m", "code")).withColumn(
        "code", F.col("code").cast("int"))


@register("pq_lut", f"""WITH {_PQ}
SELECT qid, cid, m, h, round(val, 6) AS val FROM lut""")
def q_pq_lut(spark, sf_dir):
    index, _, queries = _pq_index(spark, sf_dir)
    ksub = index.params.ksub
    lut = PQ.lookup_tables(index, queries).select("qid", "cid", F.posexplode("lut").alias("i", "val"))
    return lut.select("qid", "cid", (F.col("i") / ksub).cast("int").alias("m"), (F.col("i") % ksub).cast("int").alias("h"),
                      F.round("val", 6).alias("val"))


@register("pq_knn", f"WITH {_PQ}\n{O.topn('adc', N)}")
def q_pq_knn(spark, sf_dir):
    index, base, queries = _pq_index(spark, sf_dir)
    return _r6(PQ.search(index, base, queries, N), "dist")


@register("pq_range", f"WITH {_PQ}\nSELECT qid, id, round(dist, 6) AS dist FROM adc WHERE dist <= {R}")
def q_pq_range(spark, sf_dir):
    index, base, queries = _pq_index(spark, sf_dir)
    return _r6(PQ.range_search(index, base, queries, R), "dist")


# --------------------------------------------------------------------------- stored indexes (K9, L4, H5)
#
# The index is written as a table of vectors by cell, bucket or vertex; the search reads the probed ones only.


@register("ivf_lists", O.whole(f"WITH {O.SPLIT}, {O.cent()}\nSELECT cid, id FROM asg"))
def q_ivf_lists(spark, sf_dir):
    base = whole_table(spark, sf_dir)
    index = IVF.build_ivfflat(base, _label_centroids(base))
    return IVF.write_lists(index, scratch_path(spark, "ivf-lists")).select(F.col("cid").cast("int").alias("cid"), "id")


@register("ivf_stored_knn", O.tenths(_IVF_KNN_SQL))
def q_ivf_stored_knn(spark, sf_dir):
    index, _, queries = _ivf_index(spark, sf_dir, TENTH)
    IVF.write_lists(index, scratch_path(spark, "ivf-lists"))
    return _r6(IVF.search(index, queries, N, NPROBE), "dist")


@register("lsh_stored_knn", O.tenths(_LSH_KNN_SQL))
def q_lsh_stored_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    lists = LSH.write_lists(LSH_MODEL, base, scratch_path(spark, "lsh-lists"))
    return _r6(LSH.search(LSH_MODEL, base, queries, N, lists=lists), "dist")


@register("cube_stored_knn", O.tenths(_CUBE_KNN_SQL))
def q_cube_stored_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir, TENTH)
    lists = H.write_lists(CUBE_MODEL, base, scratch_path(spark, "cube-lists"))
    return _r6(H.search(CUBE_MODEL, base, queries, N, lists=lists), "dist")


@register("lsh_stored_range", ORACLE["lsh_range"])
def q_lsh_stored_range(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    lists = LSH.write_lists(LSH_MODEL, base, scratch_path(spark, "lsh-lists"))
    return _r6(LSH.range_search(LSH_MODEL, base, queries, R, lists=lists), "dist")


@register("cube_stored_range", _CUBE_RANGE_SQL)
def q_cube_stored_range(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    lists = H.write_lists(CUBE_MODEL, base, scratch_path(spark, "cube-lists"))
    return _r6(H.range_search(CUBE_MODEL, base, queries, R, lists=lists), "dist")


@register("lsh_ids_knn", _LSH_KNN_SQL)
def q_lsh_ids_knn(spark, sf_dir):
    """The stored index holds ids only; the candidates' vectors are fetched from the base."""
    base, queries = fixture_split(spark, sf_dir)
    index = LSH.write_index(LSH_MODEL, base, scratch_path(spark, "lsh-index"))
    return _r6(LSH.search_index(LSH_MODEL, index, base, queries, N), "dist")


@register("cube_stored_knn_capped", _CUBE_CAPPED_SQL)
def q_cube_stored_knn_capped(spark, sf_dir):
    """The vertex sizes plan the probes that a capped search reaches; no others are read."""
    base, queries = fixture_split(spark, sf_dir)
    lists = H.write_lists(CUBE_MODEL_CAPPED, base, scratch_path(spark, "cube-lists"))
    sizes = H.write_sizes(lists, scratch_path(spark, "cube-sizes"))
    return _r6(H.search(CUBE_MODEL_CAPPED, base, queries, N, lists=lists, sizes=sizes), "dist")


# --------------------------------------------------------------------------- settings of high recall
#
# The same searches with settings that find nine tenths of the true neighbours (README).  The table's vectors have
# no clusters, so every method has to look at most of them for that.

RECALL_NPROBE = 9
RECALL_LSH = LSH.draw_lsh(LSH.LSHParams(k=2, L=6, w=8.0, seed=1), DIM)
RECALL_CUBE = H.draw_cube(H.CubeParams(kproj=7, w=4.0, max_candidates=0, probes=32, seed=1), DIM)
RECALL_REFINE = 200
RECALL_PQ = PQ.PQParams(m=PQ_M, nbits=PQ_NBITS, nprobe=RECALL_NPROBE, seed=1, metric="l2", train_iters=PQ_ITERS)


@register("ivfflat_recall_knn", _IVF_KNN_SQL.replace(O.probes(NPROBE), O.probes(RECALL_NPROBE)))
def q_ivfflat_recall_knn(spark, sf_dir):
    index, _, queries = _ivf_index(spark, sf_dir)
    return _r6(IVF.search(index, queries, N, RECALL_NPROBE), "dist")


@register("lsh_recall_knn", f"""WITH {O.SPLIT},
{O.lsh_buckets_cte('bb', 'base', 'id', 'v', RECALL_LSH)},
{O.lsh_buckets_cte('qb', 'queries', 'qid', 'qv', RECALL_LSH)},
cands AS (SELECT DISTINCT qb.qid, bb.id FROM qb JOIN bb ON bb.t = qb.t AND bb.bucket = qb.bucket),
lpairs AS (SELECT c.qid, c.id, {O.dist('q.qv', 'b.v')} AS dist
           FROM cands c JOIN queries q ON q.qid = c.qid JOIN base b ON b.id = c.id)
{O.topn('lpairs', N)}""")
def q_lsh_recall_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    return _r6(LSH.search(RECALL_LSH, base, queries, N), "dist")


@register("cube_recall_knn", f"""WITH {O.SPLIT},
{O.cube_codes_cte('bcode', 'base', 'id', 'v', RECALL_CUBE)},
{O.cube_codes_cte('qcode', 'queries', 'qid', 'qv', RECALL_CUBE)},
qprobe AS (SELECT q.qid, xor(q.code, mk.mask) AS code FROM qcode q, {O.masks_values(H.probe_masks(7, 32))}),
cdists AS (SELECT p.qid, b.id, {O.dist('q.qv', 'b.v')} AS dist FROM qprobe p JOIN bcode c ON c.code = p.code
           JOIN queries q ON q.qid = p.qid JOIN base b ON b.id = c.id)
{O.topn('cdists', N)}""")
def q_cube_recall_knn(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    return _r6(H.search(RECALL_CUBE, base, queries, N), "dist")


@register("pq_recall_knn", f"""WITH {O.SPLIT}, {O.cent()},
{O.pq_ctes(PQ_M, 1 << PQ_NBITS, DIM // PQ_M, PQ_ITERS, RECALL_NPROBE, 1)},
near AS (SELECT qid, id FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS r FROM adc) t WHERE r <= {RECALL_REFINE}),
refined AS (SELECT n.qid, n.id, {O.dist('q.qv', 'b.v')} AS dist FROM near n JOIN queries q ON q.qid = n.qid JOIN base b ON b.id = n.id)
{O.topn('refined', N)}""")
def q_pq_recall_knn(spark, sf_dir):
    """Asymmetric distances choose the candidates, true distances rank them."""
    base, queries = fixture_split(spark, sf_dir)
    index = PQ.build_ivfpq(base, RECALL_PQ, _label_centroids(base))
    return _r6(PQ.search(index, base, queries, N, refine=RECALL_REFINE), "dist")


# One coefficient for each dimension that occurs, by repeated remainders in SQL.
@register("lsh_coefficients", """WITH RECURSIVE power(l, r) AS (
  SELECT 0, 1 UNION ALL SELECT l + 1, ((r * -5) % 256 + 256) % 256 FROM power WHERE l + 1 < (SELECT max(len(embedding)) FROM embeddings))
SELECT l::INTEGER AS l, r::BIGINT AS r FROM power""")
def q_lsh_coefficients(spark, sf_dir):
    dims = whole_table(spark, sf_dir).select(F.posexplode("v").alias("l", "x")).select("l").distinct()
    coef = F.array(*(F.lit(int(c)).cast("bigint") for c in lsh_coefficients(DIM)))
    return dims.select("l", F.element_at(coef, F.col("l") + 1).alias("r"))


# --------------------------------------------------------------------------- ingest


_INGEST_SQL = """SELECT vec_id AS id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS dim,
       round(unnest(embedding)::DOUBLE, 6) AS x FROM embeddings"""
_INGEST_IDX_SQL = """SELECT vec_id AS id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS dim,
       least(255.0, greatest(0.0, round((unnest(embedding)::DOUBLE + 1.0) * 127.5))) AS x FROM embeddings"""


def _ingest(spark, sf_dir, kind: str, transform=None, rows: int = 0, cols: int = 0):
    vecs = canonical(read_embeddings(spark, sf_dir), keep=())
    if transform is not None:
        vecs = vecs.select("id", transform.alias("v"))
    path = scratch_path(spark, f"ingest-{kind}")
    B.write_vectors(vecs, path, kind, rows=rows, cols=cols)
    back = B.read_vectors(spark, path, kind)
    return back.select("id", F.posexplode("v").alias("dim", "x"))


@register("ingest_fvecs", _INGEST_SQL)
def q_ingest_fvecs(spark, sf_dir):
    return _r6(_ingest(spark, sf_dir, "fvecs"), "x")


@register("ingest_text", _INGEST_SQL)
def q_ingest_text(spark, sf_dir):
    return _r6(_ingest(spark, sf_dir, "text"), "x")


@register("ingest_idx", _INGEST_IDX_SQL)
def q_ingest_idx(spark, sf_dir):
    pixels = F.transform("v", lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.round((x + 1.0) * 127.5))))
    return _ingest(spark, sf_dir, "idx", pixels, rows=8, cols=8)


# --------------------------------------------------------------------------- timing (M3, M4)


@register("throughput", f"""WITH {_EVAL_CTES}
SELECT 'ivfflat' AS method, {N}::INTEGER AS n, round(avg(af), 6) AS average_af, round(avg(recall), 6) AS recall_at_n,
       true AS timed FROM pq""")
def q_throughput(spark, sf_dir):
    """Evaluation row of IVFFlat against the exact scan; the measured times must be there and agree."""
    index, base, queries = _ivf_index(spark, sf_dir)
    row, _, _ = M.throughput(lambda: others(IVF.search(index, queries, N + 1, NPROBE), N),
                             lambda: others(exact.knn(base, queries, N + 1), N), queries, N, "ivfflat")
    agree = F.abs(F.col("qps") * F.col("ms_per_query") - 1000.0) < 1e-3
    return _r6(row, "average_af", "recall_at_n").select(
        "method", "n", "average_af", "recall_at_n",
        (agree & (F.col("search_seconds") > 0) & (F.col("truth_ms_per_query") > 0)).alias("timed"))


# The evaluation job itself (M6) through the method surface (U1), which draws the LSH offsets and the projections for
# the table's dimension (L1, H1, H2).  The queries are half as long as their rows, so no distance is 0.

_HALF_SPLIT = f"""{O.SPLIT.replace('queries AS', 'given AS')},
queries AS (SELECT qid, list_transform(qv, lambda x: x * 0.5) AS qv FROM given)"""


def _job_sql(method: str, ctes: str) -> str:
    return f"""WITH {ctes}, pairs AS (SELECT q.qid, b.id, {O.dist('q.qv', 'b.v')} AS dist FROM queries q, base b),
{O.ranked('truth', 'pairs', N)}, {O.ranked('approx', 'found', N)}, {O.eval_per_query(N)}
SELECT '{method}' AS method, {N}::INTEGER AS n, round(avg(af), 6) AS average_af, round(avg(recall), 6) AS recall_at_n,
  (SELECT count(*) FROM found WHERE dist <= {R})::BIGINT AS n_hits FROM pq"""


def _job(spark, sf_dir, method, config):
    base, queries = fixture_split(spark, sf_dir)
    run = API.evaluate(method, base, queries.withColumn("qv", F.transform("qv", lambda x: x * 0.5)), N, R, config,
                       keep_hits=False)
    n_hits = run.hit_counts.agg(F.sum("hits")).first()[0] or 0
    row = run.evaluation.select("method", "n", "average_af", "recall_at_n", F.lit(n_hits).cast("bigint").alias("n_hits"))
    return _r6(row, "average_af", "recall_at_n")


@register("evaluate_lsh", _job_sql("lsh", _LSH_CTES.replace(O.SPLIT, _HALF_SPLIT) + ", found AS (SELECT * FROM lpairs)"))
def q_evaluate_lsh(spark, sf_dir):
    return _job(spark, sf_dir, "lsh", LSH.LSHParams(k=4, L=5, w=4.0, seed=1))


@register("evaluate_cube", _job_sql("hypercube", _CUBE_CTES.replace(O.SPLIT, _HALF_SPLIT) + ", found AS (SELECT * FROM cdists_capped)"))
def q_evaluate_cube(spark, sf_dir):
    return _job(spark, sf_dir, "hypercube", H.CubeParams(kproj=7, w=4.0, max_candidates=CUBE_CAP, probes=8, seed=1))


# --------------------------------------------------------------------------- result report


_NL = "chr(10)"
_REPORT_CONFIG = f"%s  N = {N}%s  R = {R}%s  nprobe = {NPROBE}"


@register("result_report", f"""WITH {_EVAL_CTES},
cmp AS (SELECT a.qid, a.rank, a.id, a.dist, coalesce(t.dist, a.dist) AS true_dist
        FROM approx a LEFT JOIN truth t ON t.qid = a.qid AND t.rank = a.rank),
nbt AS (SELECT qid, string_agg(printf('  %d. id %d at %.6f (exact: %.6f)', rank, id, dist, true_dist), {_NL} ORDER BY rank) AS nb
        FROM cmp GROUP BY qid),
rgt AS (SELECT qid, string_agg(printf('  within radius: id %d at %.6f', id, dist), {_NL} ORDER BY dist, id) AS rg
        FROM cands WHERE dist <= {R} AND id <> qid GROUP BY qid)
SELECT nbt.qid AS qid, concat_ws({_NL}, printf('query %d', nbt.qid), nbt.nb, rgt.rg) AS report
FROM nbt LEFT JOIN rgt ON rgt.qid = nbt.qid
UNION ALL
SELECT -1, printf('method: ivfflat{_REPORT_CONFIG}', chr(10), chr(10), chr(10)) ||
           printf('%squality: approximation factor %.6f, recall %.6f', chr(10), avg(af), avg(recall)) FROM pq""")
def q_result_report(spark, sf_dir):
    index, base, queries = _ivf_index(spark, sf_dir)
    row, approx, truth = M.throughput(lambda: others(IVF.search(index, queries, N + 1, NPROBE), N),
                                      lambda: others(exact.knn(base, queries, N + 1), N), queries, N, "ivfflat")
    cmp = M.truth_compare(approx, truth)
    hits = IVF.range_search(index, queries, R, NPROBE).where("id <> qid")
    lines = SINK.report_lines(cmp, hits, row, {"N": N, "R": R, "nprobe": NPROBE}, timings=False)
    return lines.select(F.col("key").alias("qid"), F.col("value").alias("report"))


# P7 on the whole table: the queries of the five smallest ids are moved out to three times their length, where no row
# is near, and are also coarse centroids (cid 100000 + qid; their number doesn't grow); one cell is probed.
# Those queries' nearest centroid is themselves, with an empty cell, so they take the exact fallback and the
# others the ADC answer.
FALLBACK_CID0, FALLBACK_BELOW, FALLBACK_OUT = 100000, 100, 3.0
_PQ_FALLBACK = f"""{O.SPLIT.replace('queries AS', 'given AS')},
queries AS (SELECT qid, CASE WHEN qid < {FALLBACK_BELOW} THEN list_transform(qv, lambda x: x * {FALLBACK_OUT}::DOUBLE) ELSE qv END AS qv FROM given),
{O.cent(extra=f"SELECT ({FALLBACK_CID0} + qid)::INTEGER AS cid, qv AS c FROM queries WHERE qid < {FALLBACK_BELOW}")},
{O.pq_ctes(PQ_M, 1 << PQ_NBITS, DIM // PQ_M, PQ_ITERS, 1, 1)},
lonely AS (SELECT q.qid, q.qv FROM queries q WHERE NOT EXISTS (SELECT 1 FROM adc a WHERE a.qid = q.qid)),
fbp AS (SELECT l.qid, b.id, {O.dist('l.qv', 'b.v')} AS dist FROM lonely l, base b)"""


@register("pq_fallback", f"""WITH {_PQ_FALLBACK}
SELECT * FROM ({O.topn('adc', N)}) s
UNION ALL
SELECT * FROM ({O.topn('fbp', N)}) f""")
def q_pq_fallback(spark, sf_dir):
    base, queries = fixture_split(spark, sf_dir)
    far = F.transform("qv", lambda x: x * FALLBACK_OUT)
    queries = queries.withColumn("qv", F.when(F.col("qid") < FALLBACK_BELOW, far).otherwise(F.col("qv")))
    medians = K.label_medians(base)
    extra = queries.where(F.col("qid") < FALLBACK_BELOW).select((F.lit(FALLBACK_CID0) + F.col("qid")).cast("int").alias("cid"), F.col("qv").alias("c"))
    cents = K.centroid_matrix(medians.unionByName(extra))
    params = PQ.PQParams(m=PQ_M, nbits=PQ_NBITS, nprobe=1, seed=1, metric="l2", train_iters=PQ_ITERS)
    index = PQ.build_ivfpq(base, params, cents)
    return _r6(PQ.search(index, base, queries, N), "dist")
