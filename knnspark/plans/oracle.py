"""DuckDB SQL builders for the independent oracle of every registered query.

The SQL mirrors each operator's *semantics* in plain relational form (cross joins, windows,
list functions) over the same parquet tables; it is only used to check results at small scale.
"""

from __future__ import annotations

from knnspark.functions.hashing import SPLITMIX_GAMMA, SPLITMIX_MUL1, SPLITMIX_MUL2

# Base and queries of ``embeddings`` (FIXTURES.md §1), same as ``sources.vectors.fixture_split``.
SPLIT = """base AS (SELECT vec_id::BIGINT AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
queries AS (
  SELECT vec_id::BIGINT AS qid, embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id % 20 = 0)"""

# The same with every tenth row as a query.
TENTHS = SPLIT.replace("% 20", "% 10")


def tenths(sql: str) -> str:
    """``sql`` with every tenth row as a query."""
    assert SPLIT in sql
    return sql.replace(SPLIT, TENTHS)


# The operators that have no query side run over the whole table.
WHOLE = """base AS (SELECT vec_id::BIGINT AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
queries AS (SELECT vec_id::BIGINT AS qid, embedding::DOUBLE[] AS qv FROM embeddings)"""


def whole(sql: str) -> str:
    """``sql`` over the whole table instead of the split."""
    assert SPLIT in sql
    return sql.replace(SPLIT, WHOLE)


def dist(a: str, b: str, metric: str = "l2") -> str:
    if metric == "l1":
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2])))"
    return f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


def sqdist(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"


def double_lit(x) -> str:
    """A DOUBLE literal parsed from its shortest round-trip text (no DECIMAL detour)."""
    return f"'{float(x)!r}'::DOUBLE"


def double_list(values) -> str:
    return "['" + "', '".join(repr(float(x)) for x in values) + "']::DOUBLE[]"


def md5_uniform(expr: str) -> str:
    """u in (0,1) from the first 13 hex digits of an md5, identical to ``functions.hashing.md5_uniform``."""
    return f"((('0x' || substr(md5({expr}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def topn(pairs: str, n: int, dist_col: str = "dist", extra: str = "") -> str:
    """``(qid, rank, id, dist)`` rows: the ``n`` smallest ``(dist, id)`` per query of a pairs CTE."""
    return f"""SELECT qid, rank::INTEGER AS rank, id, round({dist_col}, 6) AS dist{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {dist_col}, id) AS rank FROM {pairs}) t
WHERE rank <= {n}"""


def cent(metric: str = "l2", extra: str = "") -> str:
    """Label-median centroids ``cent(cid, c)`` (plus the rows of ``extra``, a SELECT of
    ``(cid INTEGER, c DOUBLE[])``) and the nearest/second-nearest assignment ``asg``."""
    union = f"\n  UNION ALL {extra}" if extra else ""
    return f"""cent AS (
  SELECT label::INTEGER AS cid, list(m ORDER BY dim) AS c FROM (
    SELECT label, dim, median(x) AS m FROM (
      SELECT label, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM base) e
    GROUP BY label, dim) g
  GROUP BY label{union}),
cdist AS (
  SELECT b.id, c.cid, {dist('b.v', 'c.c', metric)} AS dist,
         row_number() OVER (PARTITION BY b.id ORDER BY {dist('b.v', 'c.c', metric)}, c.cid) AS r
  FROM base b, cent c),
asg AS (
  SELECT a.id, a.cid, a.dist, s.cid AS cid2, s.dist AS dist2
  FROM cdist a LEFT JOIN cdist s ON s.id = a.id AND s.r = 2 WHERE a.r = 1)"""


def probes(nprobe: int, metric: str = "l2", cents: str = "cent") -> str:
    return f"""probes AS (
  SELECT * FROM (
    SELECT q.qid, q.qv, c.cid, {dist('q.qv', 'c.c', metric)} AS cdist,
           row_number() OVER (PARTITION BY q.qid ORDER BY {dist('q.qv', 'c.c', metric)}, c.cid) AS prank
    FROM queries q, {cents} c) t
  WHERE prank <= {nprobe})"""


def other_pairs(metric: str = "l2") -> str:
    """All pairs but those of a query with its own row."""
    return f"pairs AS (SELECT q.qid, b.id, {dist('q.qv', 'b.v', metric)} AS dist FROM queries q, base b WHERE b.id <> q.qid)"


def ranked(name: str, pairs: str, n: int) -> str:
    """CTE ``name(qid, rank, id, dist)`` with the top ``n`` rows per query (unrounded)."""
    return f"""{name} AS (
  SELECT qid, rank, id, dist FROM (
    SELECT qid, id, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM {pairs}) t
  WHERE rank <= {n})"""


def eval_per_query(n: int) -> str:
    """``pq(qid, af, recall)`` from CTEs ``approx`` and ``truth``."""
    return f"""a1 AS (SELECT qid, dist AS a_dist FROM approx WHERE rank = 1),
t1 AS (SELECT qid, dist AS t_dist FROM truth WHERE rank = 1),
hits AS (SELECT a.qid, count(*) AS hits FROM (SELECT DISTINCT qid, id FROM approx) a
         WHERE EXISTS (SELECT 1 FROM truth t WHERE t.qid = a.qid AND t.id = a.id AND t.rank <= {n})
         GROUP BY a.qid),
pq AS (
  SELECT q.qid,
         CASE WHEN a1.a_dist IS NOT NULL AND t1.t_dist IS NOT NULL THEN a1.a_dist / (t1.t_dist + 1e-12) ELSE 0.0 END AS af,
         CASE WHEN a1.a_dist IS NOT NULL AND t1.t_dist IS NOT NULL THEN coalesce(hits.hits, 0) / {float(n)} ELSE 0.0 END
           AS recall
  FROM (SELECT DISTINCT qid FROM queries) q
  LEFT JOIN a1 ON a1.qid = q.qid LEFT JOIN t1 ON t1.qid = q.qid LEFT JOIN hits ON hits.qid = q.qid)"""


# --------------------------------------------------------------------------- LSH


def lsh_hash(vec: str, offsets, coef, w: float) -> str:
    cells = f"list_transform(list_zip({vec}, {double_list(offsets)}), lambda p: floor((p[1] - p[2]) / {double_lit(w)})::BIGINT)"
    r = "[" + ", ".join(str(int(c)) for c in coef) + "]::BIGINT[]"
    return (f"(list_sum(list_transform(list_zip(list_reverse({cells}), {r}), "
            f"lambda p: (((p[1] % 256) + 256) % 256 * p[2]) % 256)) % 256)")


def lsh_bucket(vec: str, model, t: int) -> str:
    p = model.params
    shift = 32 // p.k if p.k > 1 else 0
    g = "0::BIGINT"
    for j in range(p.k):
        h = lsh_hash(vec, model.offsets[t, j], model.coef, p.w)
        g = f"((({g}) << {shift}) | {h}) & 4294967295"
    return f"(({g}) % {int(p.table_size)})"


def lsh_buckets_cte(name: str, src: str, key: str, vec: str, model, extra: str = "") -> str:
    arr = "[" + ", ".join(lsh_bucket(vec, model, t) for t in range(model.params.L)) + "]"
    return f"""{name} AS (
  SELECT {key}{extra}, (unnest(generate_series(0, {model.params.L - 1})))::INTEGER AS t, unnest({arr})::BIGINT AS bucket
  FROM {src})"""


# --------------------------------------------------------------------------- hypercube

_U64 = "18446744073709551616::UHUGEINT"


def cube_codes_cte(name: str, src: str, key: str, vec: str, model) -> str:
    """``name(key, code)``: projections inlined, splitmix64 coin flips in UHUGEINT arithmetic."""
    p = model.params
    rows = ", ".join(f"({i}, {double_list(model.P[i])}, {double_lit(model.t[i])})" for i in range(p.kproj))
    seed = int(p.seed) & 0xFFFFFFFFFFFFFFFF
    return f"""{name}_p AS (SELECT * FROM (VALUES {rows}) x(i, p, t)),
{name}_c AS (
  SELECT s.{key} AS key, cp.i, floor(({dot(f's.{vec}', 'cp.p')} + cp.t) / {double_lit(p.w)})::BIGINT AS cell
  FROM {src} s, {name}_p cp),
{name}_k0 AS (
  SELECT key, i, xor(xor((i::UBIGINT << 32),
                        CASE WHEN cell < 0 THEN (cell::HUGEINT + 18446744073709551616)::UBIGINT ELSE cell::UBIGINT END),
                    {seed}::UBIGINT) AS x FROM {name}_c),
{name}_k1 AS (SELECT key, i, ((x::UHUGEINT + {SPLITMIX_GAMMA}::UHUGEINT) % {_U64})::UBIGINT AS x FROM {name}_k0),
{name}_k2 AS (SELECT key, i, ((xor(x, x >> 30)::UHUGEINT * {SPLITMIX_MUL1}::UHUGEINT) % {_U64})::UBIGINT AS x
  FROM {name}_k1),
{name}_k3 AS (SELECT key, i, ((xor(x, x >> 27)::UHUGEINT * {SPLITMIX_MUL2}::UHUGEINT) % {_U64})::UBIGINT AS x
  FROM {name}_k2),
{name} AS (
  SELECT key AS {key}, sum(((xor(x, x >> 31) & 1::UBIGINT)::BIGINT) << i)::BIGINT AS code FROM {name}_k3 GROUP BY key)"""


def masks_values(masks) -> str:
    return "(VALUES " + ", ".join(f"({i + 1}, {int(m)}::BIGINT)" for i, m in enumerate(masks)) + ") mk(prank, mask)"


# --------------------------------------------------------------------------- training


def train_ctes(k: int, iters: int, seed: int = 1, metric: str = "l2", src: str = "base", tol: int = 1) -> str:
    """CTEs ``s`` (md5-ordered sample of floor(sqrt(n)) points), ``c{r}`` (k-means++ seeds by an
    exponential race, one CTE per round) and ``cen{i}`` (centroids after ``i`` k-medians steps).

    The rounds are unrolled to the limit; once a round changed at most ``tol`` assignments
    (``go{i}`` false), the centroids stay as they are."""
    parts = [f"""s AS MATERIALIZED (
  SELECT id, v FROM {src}
  QUALIFY row_number() OVER (ORDER BY md5(concat_ws(':', '{seed}', id::VARCHAR)), id)
          <= (SELECT floor(sqrt(count(*))) FROM {src})),
c0 AS (
  SELECT 0 AS cid, id, v FROM s
  ORDER BY -ln({md5_uniform(f"concat_ws(':', '{seed}', '0', id::VARCHAR)")}), id LIMIT 1)"""]
    for r in range(1, k):
        u = md5_uniform(f"concat_ws(':', '{seed}', '{r}', s.id::VARCHAR)")
        parts.append(f"""d{r} AS (
  SELECT s.id, s.v, min({dist('s.v', 'c.v', metric)}) AS d, any_value({u}) AS u FROM s, c{r - 1} c GROUP BY s.id, s.v),
c{r} AS MATERIALIZED (
  SELECT * FROM c{r - 1}
  UNION ALL (SELECT {r} AS cid, id, v FROM d{r} WHERE d > 0 ORDER BY -ln(u) / (d * d), id LIMIT 1))""")
    parts.append(f"seeds AS (SELECT cid, id, v FROM c{k - 1})")
    parts.append("cen0 AS MATERIALIZED (SELECT cid::INTEGER AS cid, v AS c FROM seeds)")
    parts.append("go0 AS MATERIALIZED (SELECT true AS go)")
    for i in range(iters):
        before = f"LEFT JOIN a{i - 1} o ON o.id = a.id" if i else ""
        old = "o.cid" if i else "0"
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT id, cid FROM (
    SELECT s.id, c.cid, row_number() OVER (PARTITION BY s.id ORDER BY {dist('s.v', 'c.c', metric)}, c.cid) AS r
    FROM s, cen{i} c) t WHERE r = 1 AND (SELECT go FROM go{i})),
go{i + 1} AS MATERIALIZED (
  SELECT (SELECT go FROM go{i}) AND (SELECT count(*) FROM a{i} a {before} WHERE a.cid IS DISTINCT FROM {old}) > {tol} AS go),
m{i} AS (
  SELECT a.cid, e.dim, median(e.x) AS m
  FROM a{i} a JOIN (SELECT id, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM s) e ON e.id = a.id
  GROUP BY a.cid, e.dim),
cen{i + 1} AS MATERIALIZED (
  SELECT c.cid, coalesce(n.c, c.c) AS c FROM cen{i} c
  LEFT JOIN (SELECT cid, list(m ORDER BY dim) AS c FROM m{i} GROUP BY cid) n ON n.cid = c.cid)""")
    return ",\n".join(parts)


# --------------------------------------------------------------------------- IVFPQ


def pq_ctes(M: int, ksub: int, ds: int, iters: int, nprobe: int, seed: int = 1) -> str:
    """CTEs after ``cent``/``asg``: ``parts``, codebook seeding ``cb{r}``, Lloyd rounds ``bk{i}``,
    the final codebook ``cbf(m, h, cw)``, codes ``enc(id, cid, m, code)``, probes, ``lut`` and ``adc``."""
    def u(expr_m, r, id_expr):
        return md5_uniform(f"concat_ws(':', '{seed}', {expr_m}::VARCHAR, '{r}', {id_expr}::VARCHAR)")
    out = [f"""res AS (
  SELECT a.cid, b.id, list_transform(list_zip(b.v, c.c), lambda p: p[1] - p[2]) AS r
  FROM base b JOIN asg a ON a.id = b.id JOIN cent c ON c.cid = a.cid),
parts AS MATERIALIZED (
  SELECT id, unnest(generate_series(0, {M - 1}))::INTEGER AS m,
         unnest(list_transform(generate_series(0, {M - 1}), lambda i: r[i * {ds} + 1 : i * {ds} + {ds}])) AS sub
  FROM res),
pcnt AS (SELECT m, count(*) AS n FROM parts GROUP BY m),
cb0 AS MATERIALIZED (
  SELECT m, 0 AS h, sub AS cw FROM (
    SELECT m, id, sub, row_number() OVER (PARTITION BY m ORDER BY -ln({u('m', 0, 'id')}), id) AS rr FROM parts) t
  WHERE rr = 1)"""]
    for r in range(1, ksub):
        out.append(f"""sd{r} AS (
  SELECT p.m, p.id, any_value(p.sub) AS sub, min({sqdist('p.sub', 'c.cw')}) AS d
  FROM parts p JOIN cb{r - 1} c ON c.m = p.m GROUP BY p.m, p.id),
cb{r} AS MATERIALIZED (
  SELECT * FROM cb{r - 1}
  UNION ALL
  SELECT m, {r} AS h, sub AS cw FROM (
    SELECT m, id, sub, row_number() OVER (PARTITION BY m ORDER BY -ln({u('m', r, 'id')}) / d, id) AS rr
    FROM sd{r} WHERE d > 0) t
  WHERE rr = 1)""")
    out.append(f"""kact AS (SELECT m, least({ksub}, n) AS k FROM pcnt),
ns AS (SELECT m, count(*) AS s FROM cb{ksub - 1} GROUP BY m),
bk0 AS MATERIALIZED (
  SELECT k.m, g.h::INTEGER AS h, c.cw FROM kact k JOIN ns ON ns.m = k.m, range(0, {ksub}) g(h)
  JOIN cb{ksub - 1} c ON c.m = k.m AND c.h = g.h % ns.s WHERE g.h < k.k),
act0 AS (SELECT m FROM kact WHERE k > 0)""")
    for i in range(iters):
        prev = f"LEFT JOIN as{i - 1} o ON o.m = a.m AND o.id = a.id" if i > 0 else ""
        chg = "CASE WHEN o.h IS NULL OR o.h <> a.h THEN 1 ELSE 0 END" if i > 0 else "1"
        out.append(f"""as{i} AS MATERIALIZED (
  SELECT m, id, h FROM (
    SELECT p.m, p.id, c.h,
           row_number() OVER (PARTITION BY p.m, p.id ORDER BY {sqdist('p.sub', 'c.cw')}, c.h) AS rr
    FROM parts p JOIN bk{i} c ON c.m = p.m WHERE p.m IN (SELECT m FROM act{i})) t
  WHERE rr = 1),
ch{i} AS (SELECT a.m, sum({chg}) AS ch FROM as{i} a {prev} GROUP BY a.m),
act{i + 1} AS MATERIALIZED (SELECT m FROM ch{i} WHERE ch > 0),
mn{i} AS (
  SELECT m, h, list(x ORDER BY dim) AS cw FROM (
    SELECT a.m, a.h, e.dim, avg(e.x) AS x
    FROM as{i} a JOIN (SELECT m, id, unnest(sub) AS x, unnest(generate_series(0, len(sub) - 1)) AS dim FROM parts) e
      ON e.m = a.m AND e.id = a.id
    GROUP BY a.m, a.h, e.dim) t
  GROUP BY m, h),
emp{i} AS (
  SELECT c.m, c.h FROM bk{i} c WHERE c.m IN (SELECT m FROM act{i + 1})
  AND NOT EXISTS (SELECT 1 FROM as{i} a WHERE a.m = c.m AND a.h = c.h)),
rp{i} AS (
  SELECT m, h, sub FROM (
    SELECT e.m, e.h, p.sub, row_number() OVER (
      PARTITION BY e.m, e.h
      ORDER BY md5(concat_ws(':', '{seed}', 'empty', '{i}', e.m::VARCHAR, e.h::VARCHAR, p.id::VARCHAR)), p.id) AS rr
    FROM emp{i} e JOIN parts p ON p.m = e.m) t
  WHERE rr = 1),
bk{i + 1} AS MATERIALIZED (
  SELECT c.m, c.h,
         CASE WHEN c.m IN (SELECT m FROM act{i + 1}) THEN coalesce(mn.cw, rp.sub, c.cw) ELSE c.cw END AS cw
  FROM bk{i} c LEFT JOIN mn{i} mn ON mn.m = c.m AND mn.h = c.h LEFT JOIN rp{i} rp ON rp.m = c.m AND rp.h = c.h)""")
    out.append(f"""nk AS (SELECT m, count(*) AS k FROM bk{iters} GROUP BY m),
cbf AS MATERIALIZED (
  SELECT g.h::INTEGER AS h, nk.m, c.cw FROM nk, range(0, {ksub}) g(h)
  JOIN bk{iters} c ON c.m = nk.m AND c.h = g.h % nk.k),
enc AS MATERIALIZED (
  SELECT id, m, h AS code FROM (
    SELECT p.id, p.m, c.h, row_number() OVER (PARTITION BY p.id, p.m ORDER BY {sqdist('p.sub', 'c.cw')}, c.h) AS rr
    FROM parts p JOIN cbf c ON c.m = p.m) t
  WHERE rr = 1),
{probes(nprobe)},
qres AS (
  SELECT p.qid, p.cid, list_transform(list_zip(p.qv, c.c), lambda x: x[1] - x[2]) AS r
  FROM probes p JOIN cent c ON c.cid = p.cid),
qparts AS (
  SELECT qid, cid, unnest(generate_series(0, {M - 1}))::INTEGER AS m,
         unnest(list_transform(generate_series(0, {M - 1}), lambda i: r[i * {ds} + 1 : i * {ds} + {ds}])) AS sub
  FROM qres),
lut AS MATERIALIZED (
  SELECT q.qid, q.cid, q.m, c.h, {sqdist('q.sub', 'c.cw')} AS val FROM qparts q JOIN cbf c ON c.m = q.m),
adc AS (
  SELECT l.qid, e.id, sqrt(sum(l.val)) AS dist
  FROM lut l JOIN asg a ON a.cid = l.cid JOIN enc e ON e.id = a.id AND e.m = l.m AND e.code = l.h
  GROUP BY l.qid, e.id)""")
    return ",\n".join(out)
