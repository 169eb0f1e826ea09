"""DuckDB statements equal to the registered queries (the correctness gate).

The driver registers the parquet tables as views; every statement below
rebuilds the rating views from them with CTEs and computes the same result
as the Spark query of the same name.  Windows (``dense_rank``, ``ntile``)
are fine here: the oracle runs on one machine at a small scale factor.
"""

from __future__ import annotations

from .queries import PCA_CATEGORIES, PROBE_CATEGORIES, PROBE_ITEMS, TOP_CATEGORIES

ORACLE: dict[str, str] = {}


def _in(values: list[int]) -> str:
    return "(" + ", ".join(str(int(v)) for v in values) + ")"


def _values(values: list[int], name: str) -> str:
    rows = ", ".join(f"({int(v)}, {i})" for i, v in enumerate(values))
    return f"(SELECT * FROM (VALUES {rows}) t({name}, position))"


BASE = """
reviews AS (
  SELECT c.c_name AS user_name, o.o_custkey AS user_id, l.l_partkey AS item_id,
         p.p_name AS item_name, p.p_type AS category, l.l_quantity / 10.0 AS rating
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey),
nullable AS (
  SELECT user_name, user_id, item_id, item_name,
         CASE WHEN category <> 'PROMO' THEN category END AS category,
         CASE WHEN rating <> 5.0 THEN rating END AS rating
  FROM reviews),
user_codes AS (
  SELECT user_name, CAST(dense_rank() OVER (ORDER BY user_name) - 1 AS BIGINT) AS user_id
  FROM (SELECT DISTINCT user_name FROM reviews WHERE user_name IS NOT NULL)),
category_codes AS (
  SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS category_id
  FROM (SELECT DISTINCT category FROM reviews WHERE category IS NOT NULL)),
triples AS (
  SELECT coalesce(u.user_id, -1) AS user_id, r.item_id, r.rating
  FROM reviews r LEFT JOIN user_codes u ON r.user_name = u.user_name),
item_means AS (SELECT item_id, avg(rating) AS rating FROM reviews GROUP BY item_id),
lookup AS (
  SELECT n.item_id, n.item_name, n.category, n.category_id, m.rating
  FROM (SELECT DISTINCT r.item_id, r.item_name, r.category,
               coalesce(c.category_id, -1) AS category_id
        FROM reviews r LEFT JOIN category_codes c ON r.category = c.category) n
  JOIN item_means m ON n.item_id = m.item_id),
item_vectors AS (
  SELECT k.*, CAST(e.embedding AS DOUBLE[]) AS features
  FROM lookup k JOIN embeddings e ON k.item_id = e.vec_id)"""


def with_base(extra_ctes: str, body: str) -> str:
    ctes = BASE + ("," + extra_ctes if extra_ctes.strip() else "")
    return f"WITH {ctes}\n{body}"


def supported(source: str) -> str:
    return f"""
sup_rows AS (
  SELECT user_name, item_name, rating, category FROM {source}
  WHERE user_name IS NOT NULL AND item_name IS NOT NULL AND rating IS NOT NULL
    AND category IS NOT NULL),
sup_stats AS (
  SELECT item_name, avg(rating) AS mean_rating, count(*) AS n_reviews
  FROM sup_rows GROUP BY item_name HAVING count(*) > 5),
supported AS (
  SELECT r.user_name, r.item_name, r.rating, r.category, s.mean_rating, s.n_reviews
  FROM sup_rows r JOIN sup_stats s ON r.item_name = s.item_name)"""


def long_vectors(source: str, keys: str, features: str = "features") -> str:
    """``keys, dim, value`` rows of an array column."""
    return f"""SELECT {keys}, CAST(i - 1 AS INTEGER) AS dim, round({features}[i], 6) AS value
FROM (SELECT *, unnest(range(1, len({features}) + 1)) AS i FROM {source})"""


def probe_items_cte(items: list[int]) -> str:
    return f"""
probe_rows AS (
  SELECT v.* FROM item_vectors v JOIN {_values(items, 'item_id')} w ON v.item_id = w.item_id),
probe_dims AS (
  SELECT i - 1 AS dim, avg(features[i]) AS m
  FROM (SELECT features, unnest(range(1, len(features) + 1)) AS i FROM probe_rows)
  GROUP BY i),
probe AS (SELECT list(m ORDER BY dim) AS p FROM probe_dims)"""


# ---------------------------------------------------------------- step 0
ORACLE["top_items"] = with_base(f"""
top AS (
  SELECT item_id, avg(category_id) AS category_id, avg(rating) AS rating
  FROM lookup WHERE category_id IN {_in(TOP_CATEGORIES)} GROUP BY item_id)""", """
SELECT t.item_id, round(t.category_id, 6) AS category_id, round(t.rating, 6) AS rating,
       n.item_name
FROM top t LEFT JOIN (SELECT DISTINCT item_id, item_name FROM lookup) n ON t.item_id = n.item_id""")

# ---------------------------------------------------------------- step 1: prepare
ORACLE["drop_null_rows"] = with_base("", """
SELECT user_name, user_id, item_id, item_name, category, rating FROM nullable
WHERE user_name IS NOT NULL AND user_id IS NOT NULL AND item_id IS NOT NULL
  AND item_name IS NOT NULL AND category IS NOT NULL AND rating IS NOT NULL""")

ORACLE["rating_triples"] = with_base("", "SELECT user_id, item_id, rating FROM triples")

ORACLE["encode_users"] = with_base("", "SELECT user_name, user_id FROM user_codes")

ORACLE["encode_categories"] = with_base("""
null_codes AS (
  SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS category_id
  FROM (SELECT DISTINCT category FROM nullable WHERE category IS NOT NULL))""", """
SELECT n.item_id, n.category, coalesce(c.category_id, -1) AS category_id
FROM nullable n LEFT JOIN null_codes c ON n.category = c.category""")

ORACLE["item_lookup"] = with_base("", """
SELECT item_id, item_name, category, category_id, round(rating, 6) AS rating FROM lookup""")

ORACLE["item_mean_rating"] = with_base("", """
SELECT item_id, round(rating, 6) AS rating FROM item_means""")

ORACLE["item_support"] = with_base("", """
SELECT item_name, round(avg(rating), 6) AS mean_rating, count(*) AS n_reviews
FROM reviews GROUP BY item_name HAVING count(*) > 5""")

ORACLE["supported_reviews"] = with_base(supported("nullable"), """
SELECT user_name, item_name, rating, category, round(mean_rating, 6) AS mean_rating, n_reviews
FROM supported""")

ORACLE["mean_predictor_rmse"] = with_base(supported("reviews"), """
SELECT count(rating) AS n, round(avg(rating), 6) AS mean_rating,
       round(stddev_pop(rating), 6) AS rmse
FROM supported""")

ORACLE["rating_histogram"] = with_base(supported("reviews") + """,
mm AS (SELECT min(rating) AS lo0, max(rating) AS hi0 FROM supported),
rng AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
               CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM mm),
idx AS (SELECT CAST(least(floor((s.rating - r.lo) * 10.0 / (r.hi - r.lo)), 9) AS INTEGER) AS bin
        FROM supported s, rng r),
cnt AS (SELECT bin, count(*) AS n FROM idx GROUP BY bin),
edges AS (SELECT CAST(t.i AS INTEGER) AS bin, r.lo + t.i * ((r.hi - r.lo) / 10.0) AS lo,
                 r.lo + (t.i + 1) * ((r.hi - r.lo) / 10.0) AS hi
          FROM range(10) t(i), rng r)""", """
SELECT e.bin, round(e.lo, 6) AS lo, round(e.hi, 6) AS hi, coalesce(c.n, 0) AS n
FROM edges e LEFT JOIN cnt c ON e.bin = c.bin""")

ORACLE["entity_counts"] = with_base("", """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       count(*) AS n_ratings
FROM reviews""")

# ---------------------------------------------------------------- step 3: vectors
ORACLE["item_vectors"] = with_base("", long_vectors(
    "(SELECT item_id, item_name, category, category_id, round(rating, 6) AS rating, features "
    "FROM item_vectors)",
    "item_id, item_name, category, category_id, rating"))

ORACLE["pack_vectors"] = with_base("", long_vectors(
    "(SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)",
    "item_id"))

ORACLE["vectors_by_category"] = with_base(f"""
wanted AS (
  SELECT category_id, min(position) AS position, max(position) AS last_pos
  FROM {_values(PCA_CATEGORIES, 'category_id')} GROUP BY category_id),
tagged AS (
  SELECT DISTINCT k.item_id, k.category_id, w.position, w.last_pos
  FROM lookup k JOIN wanted w ON k.category_id = w.category_id),
best AS (
  SELECT item_id, arg_max(category_id, last_pos) AS category_id,
         arg_max(position, last_pos) AS position
  FROM tagged GROUP BY item_id),
picked AS (
  SELECT b.item_id, b.category_id, CAST(b.position AS INTEGER) AS position,
         CAST(e.embedding AS DOUBLE[]) AS features
  FROM best b JOIN embeddings e ON b.item_id = e.vec_id)""",
    long_vectors("picked", "item_id, category_id, position"))

ORACLE["category_centroids"] = with_base("""
dims AS (
  SELECT category_id, i - 1 AS dim, avg(features[i]) AS avg_v
  FROM (SELECT category_id, features, unnest(range(1, len(features) + 1)) AS i
        FROM item_vectors)
  GROUP BY category_id, i),
counts AS (SELECT category_id, count(*) AS n_items FROM item_vectors GROUP BY category_id)""", """
SELECT d.category_id, c.n_items, CAST(d.dim AS INTEGER) AS dim, round(d.avg_v, 6) AS value
FROM dims d JOIN counts c ON d.category_id = c.category_id""")

ORACLE["probe_from_items"] = with_base(probe_items_cte(PROBE_ITEMS) + f""",
probe_names AS (
  SELECT string_agg(v.item_name, ', ' ORDER BY w.position, v.item_name) AS names,
         count(*) AS n_rows
  FROM item_vectors v JOIN {_values(PROBE_ITEMS, 'item_id')} w ON v.item_id = w.item_id)""", """
SELECT n.names, n.n_rows, CAST(d.dim AS INTEGER) AS dim, round(d.m, 6) AS value
FROM probe_dims d, probe_names n""")

ORACLE["probe_from_categories"] = with_base(f"""
wanted AS {_values(PROBE_CATEGORIES, 'category_id')},
cent AS (
  SELECT category_id, i - 1 AS dim, avg(features[i]) AS c
  FROM (SELECT category_id, features, unnest(range(1, len(features) + 1)) AS i
        FROM item_vectors WHERE category_id IN {_in(PROBE_CATEGORIES)})
  GROUP BY category_id, i),
pdims AS (
  SELECT c.dim, avg(c.c) AS m FROM cent c JOIN wanted w ON c.category_id = w.category_id
  GROUP BY c.dim),
pnames AS (
  SELECT string_agg(category, ', ' ORDER BY category) AS names FROM (
    SELECT DISTINCT category FROM item_vectors
    WHERE category_id IN {_in(PROBE_CATEGORIES)})),
pcount AS (
  SELECT count(*) AS n_rows FROM wanted w
  WHERE w.category_id IN (SELECT category_id FROM item_vectors))""", """
SELECT n.names, c.n_rows, CAST(d.dim AS INTEGER) AS dim, round(d.m, 6) AS value
FROM pdims d, pnames n, pcount c""")

ORACLE["nearest_items"] = with_base(probe_items_cte(PROBE_ITEMS), """
SELECT item_id, item_name, category, round(dist, 6) AS distance FROM (
  SELECT v.item_id, v.item_name, v.category, list_distance(v.features, p.p) AS dist
  FROM item_vectors v, probe p)
WHERE dist <> 0""")

_CENT_DIST = """
cent AS (
  SELECT category_id, i, avg(features[i]) AS c
  FROM (SELECT category_id, features, unnest(range(1, len(features) + 1)) AS i
        FROM item_vectors)
  GROUP BY category_id, i),
cent_vec AS (SELECT category_id, list(c ORDER BY i) AS features FROM cent GROUP BY category_id),
cat_names AS (SELECT DISTINCT category_id, category FROM item_vectors),
cat_dist AS (
  SELECT v.category_id, n.category, list_distance(v.features, p.p) AS dist
  FROM cent_vec v JOIN cat_names n ON v.category_id = n.category_id, probe p)"""

ORACLE["nearest_categories"] = with_base(probe_items_cte(PROBE_ITEMS) + "," + _CENT_DIST, """
SELECT category_id, category, round(dist, 6) AS distance FROM cat_dist WHERE dist <> 0""")

ORACLE["similarity_top15"] = with_base(probe_items_cte(PROBE_ITEMS), """
SELECT item_id, item_name, round(dist, 6) AS distance, round(1.0 / dist, 6) AS similarity
FROM (
  SELECT v.item_id, v.item_name, list_distance(v.features, p.p) AS dist
  FROM item_vectors v, probe p)
WHERE dist <> 0
ORDER BY dist, item_id
LIMIT 15""")

_PROBE_CATS = f"""
wanted AS {_values(PROBE_CATEGORIES, 'category_id')},
pc AS (
  SELECT category_id, i, avg(features[i]) AS c
  FROM (SELECT category_id, features, unnest(range(1, len(features) + 1)) AS i
        FROM item_vectors WHERE category_id IN {_in(PROBE_CATEGORIES)})
  GROUP BY category_id, i),
pdims AS (
  SELECT c.i, avg(c.c) AS m FROM pc c JOIN wanted w ON c.category_id = w.category_id
  GROUP BY c.i),
probe AS (SELECT list(m ORDER BY i) AS p FROM pdims),
pnames AS (
  SELECT string_agg(category, ', ' ORDER BY category) AS names FROM (
    SELECT DISTINCT category FROM item_vectors
    WHERE category_id IN {_in(PROBE_CATEGORIES)}))"""

ORACLE["similarity_report"] = with_base(_PROBE_CATS + "," + _CENT_DIST + """,
item_dist AS (
  SELECT v.item_id, v.item_name, list_distance(v.features, p.p) AS dist
  FROM item_vectors v, probe p),
top_i AS (
  SELECT 'item' AS kind, item_id AS id, item_name AS name, dist FROM item_dist
  WHERE dist <> 0 ORDER BY dist, item_id LIMIT 15),
top_c AS (
  SELECT 'category' AS kind, category_id AS id, category AS name, dist FROM cat_dist
  WHERE dist <> 0 ORDER BY dist, category_id LIMIT 15)""", """
SELECT kind, id, name, round(dist, 6) AS distance, round(1.0 / dist, 6) AS similarity,
       (SELECT names FROM pnames) AS probe
FROM (SELECT * FROM top_i UNION ALL SELECT * FROM top_c)""")

ORACLE["similarity_report_items"] = with_base(probe_items_cte(PROBE_ITEMS) + "," + _CENT_DIST + f""",
pnames AS (
  SELECT string_agg(v.item_name, ', ' ORDER BY w.position, v.item_name) AS names
  FROM item_vectors v JOIN {_values(PROBE_ITEMS, 'item_id')} w ON v.item_id = w.item_id),
item_dist AS (
  SELECT v.item_id, v.item_name, list_distance(v.features, p.p) AS dist
  FROM item_vectors v, probe p),
top_i AS (
  SELECT 'item' AS kind, item_id AS id, item_name AS name, dist FROM item_dist
  WHERE dist <> 0 ORDER BY dist, item_id LIMIT 15),
top_c AS (
  SELECT 'category' AS kind, category_id AS id, category AS name, dist FROM cat_dist
  WHERE dist <> 0 ORDER BY dist, category_id LIMIT 15)""", """
SELECT kind, id, name, round(dist, 6) AS distance, round(1.0 / dist, 6) AS similarity,
       (SELECT names FROM pnames) AS probe
FROM (SELECT * FROM top_i UNION ALL SELECT * FROM top_c)""")

# ---------------------------------------------------------------- step 2: folds
from .queries import FOLD_SEED, HELD_OUT, K_FOLDS  # noqa: E402


def fold_key(cols: list[str], seed: int, doubles: tuple[str, ...] = ("rating",)) -> str:
    parts = [f"'{seed}'"]
    for c in cols:
        txt = f"CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR)" if c in doubles else f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce({txt}, '\\N')")
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def folded_cte(source: str = "triples", k: int = K_FOLDS, seed: int = FOLD_SEED) -> str:
    cols = ["user_id", "item_id", "rating"]
    order = ", ".join([fold_key(cols, seed)] + [f"{c} NULLS FIRST" for c in cols])
    return f"""
folded AS (
  SELECT user_id, item_id, rating,
         CAST(ntile({k}) OVER (ORDER BY {order}) - 1 AS INTEGER) AS fold
  FROM {source})"""


ORACLE["fold_assign"] = with_base(folded_cte(), "SELECT user_id, item_id, rating, fold FROM folded")

ORACLE["fold_counts"] = with_base(folded_cte() + f""",
per AS (SELECT fold, count(*) AS n_test FROM folded GROUP BY fold),
allf AS (SELECT CAST(i AS INTEGER) AS fold FROM range({K_FOLDS}) t(i)),
filled AS (SELECT a.fold, coalesce(p.n_test, 0) AS n_test FROM allf a LEFT JOIN per p ON a.fold = p.fold)""", """
SELECT fold, CAST(sum(n_test) OVER () - n_test AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test
FROM filled""")

ORACLE["fold_train_test"] = with_base(folded_cte(), f"""
SELECT user_id, item_id, rating, fold,
       CASE WHEN fold = {HELD_OUT} THEN 'test' ELSE 'train' END AS split
FROM folded""")

# ---------------------------------------------------------------- step 4: gradient descent
from .queries import (GD_D, GD_GAIN, GD_INIT_D, GD_ITERS, GD_LAM, GD_MU,  # noqa: E402
                      GD_POWER, GD_SEED)


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def formula_cols(d: int) -> str:
    return ", ".join(
        f"CAST((id * 31 + {k * 17}) % 97 AS DOUBLE) / {_dbl(97.0)} - {_dbl(0.5)} AS f{k - 1}"
        for k in range(1, d + 1))


def gd_ctes(src: str, d: int, iters: int, lam: float, mu: float, gain: float, power: float,
            part: str | None = None) -> str:
    """Unrolled gradient steps: U0/V0 (formula) .. U{iters}/V{iters}."""
    p = f"{part}, " if part else ""

    def on(a: str, b: str) -> str:
        return f"{a}.{part} = {b}.{part} AND " if part else ""

    def pref(a: str) -> str:
        return f"{a}.{part}, " if part else ""

    out = [
        f"U0 AS (SELECT {p}id, {formula_cols(d)} FROM (SELECT DISTINCT {p}user_id AS id FROM {src}))",
        f"V0 AS (SELECT {p}id, {formula_cols(d)} FROM (SELECT DISTINCT {p}item_id AS id FROM {src}))",
    ]
    for i in range(1, iters + 1):
        gamma = gain / (i ** power)
        us = ", ".join(f"u.f{k} AS u{k}" for k in range(d))
        vs = ", ".join(f"v.f{k} AS v{k}" for k in range(d))
        dot = " + ".join(f"u.f{k} * v.f{k}" for k in range(d))
        out.append(
            f"J{i} AS (SELECT {pref('t')}t.user_id, t.item_id, t.rating, {us}, {vs}, "
            f"({dot}) - t.rating AS err FROM {src} t "
            f"JOIN U{i - 1} u ON {on('t', 'u')}t.user_id = u.id "
            f"JOIN V{i - 1} v ON {on('t', 'v')}t.item_id = v.id)")
        gu = ", ".join(f"sum(err * v{k}) AS g{k}" for k in range(d))
        gv = ", ".join(f"sum(err * u{k}) AS g{k}" for k in range(d))
        out.append(f"GU{i} AS (SELECT {p}user_id AS id, {gu} FROM J{i} GROUP BY {p}user_id)")
        out.append(f"GV{i} AS (SELECT {p}item_id AS id, {gv} FROM J{i} GROUP BY {p}item_id)")
        for side, reg, g in (("U", lam, "GU"), ("V", mu, "GV")):
            cols = ", ".join(
                f"x.f{k} - {_dbl(gamma)} * ({_dbl(2.0)} * coalesce(g.g{k}, {_dbl(0.0)}) "
                f"+ {_dbl(2.0 * reg)} * x.f{k}) AS f{k}" for k in range(d))
            out.append(f"{side}{i} AS (SELECT {pref('x')}x.id, {cols} FROM {side}{i - 1} x "
                       f"LEFT JOIN {g}{i} g ON {on('x', 'g')}x.id = g.id)")
    return ",\n".join(out)


def wide_long_sql(source: str, keys: str, d: int) -> str:
    arms = " UNION ALL ".join(
        f"SELECT {keys}, CAST({k} AS INTEGER) AS dim, round(f{k}, 6) AS value FROM {source}"
        for k in range(d))
    return arms


def hash_normal_sql(seed: int, side: str, k: int) -> str:
    h = f"md5(concat_ws(':', '{seed}', '{side}', CAST(id AS VARCHAR), '{k}'))"
    u1 = (f"((CAST(('0x' || substr({h}, 1, 13)) AS BIGINT) + {_dbl(0.5)}) "
          f"/ {_dbl(float(2 ** 52))})")
    u2 = (f"((CAST(('0x' || substr({h}, 14, 13)) AS BIGINT) + {_dbl(0.5)}) "
          f"/ {_dbl(float(2 ** 52))})")
    return f"sqrt({_dbl(-2.0)} * ln({u1})) * cos({_dbl(2.0 * 3.141592653589793)} * {u2})"


ORACLE["init_factors"] = with_base(f"""
ids AS (SELECT 'user' AS side, user_id AS id FROM (SELECT DISTINCT user_id FROM triples)
        UNION ALL SELECT 'item' AS side, item_id AS id FROM (SELECT DISTINCT item_id FROM triples)),
dims AS (SELECT side, id, CAST(k.i AS INTEGER) AS dim FROM ids, range({GD_INIT_D}) k(i))""",
    "SELECT side, id, dim, round(CASE " + " ".join(
        f"WHEN side = 'user' AND dim = {k} THEN {hash_normal_sql(GD_SEED, 'user', k)} "
        f"WHEN side = 'item' AND dim = {k} THEN {hash_normal_sql(GD_SEED, 'item', k)}"
        for k in range(GD_INIT_D)) + " END, 6) AS value FROM dims")

_GD1 = gd_ctes("triples", GD_D, 1, GD_LAM, GD_MU, GD_GAIN, GD_POWER)

ORACLE["residuals"] = with_base(_GD1, "SELECT user_id, item_id, rating, round(err, 6) AS err FROM J1")

ORACLE["gd_objective"] = with_base(_GD1 + """,
t AS (SELECT (SELECT sum(err * err) FROM J1) AS sse,
             (SELECT sum(""" + " + ".join(f"f{k} * f{k}" for k in range(GD_D)) + """) FROM U0) AS un,
             (SELECT sum(""" + " + ".join(f"f{k} * f{k}" for k in range(GD_D)) + f""") FROM V0) AS vn)""", f"""
SELECT round(sse, 6) AS sse, round(un, 6) AS user_norm, round(vn, 6) AS item_norm,
       round(sse + {_dbl(GD_LAM)} * un + {_dbl(GD_MU)} * vn, 6) AS objective
FROM t""")

ORACLE["gd_user_step"] = with_base(_GD1, wide_long_sql("(SELECT id AS user_id, * FROM U1)",
                                                       "user_id", GD_D))
ORACLE["gd_item_step"] = with_base(_GD1, wide_long_sql("(SELECT id AS item_id, * FROM V1)",
                                                       "item_id", GD_D))

_GDN = gd_ctes("triples", GD_D, GD_ITERS, GD_LAM, GD_MU, GD_GAIN, GD_POWER)
ORACLE["gd_train"] = with_base(_GDN, wide_long_sql(
    f"(SELECT 'user' AS side, * FROM U{GD_ITERS} UNION ALL SELECT 'item' AS side, * FROM V{GD_ITERS})",
    "side, id", GD_D))

ORACLE["gd_cv"] = with_base(folded_cte() + f""",
cvtrain AS (SELECT CAST(h.i AS INTEGER) AS h, f.user_id, f.item_id, f.rating
            FROM folded f, range({K_FOLDS}) h(i) WHERE f.fold <> h.i),
""" + gd_ctes("cvtrain", GD_D, GD_ITERS, GD_LAM, GD_MU, GD_GAIN, GD_POWER, part="h") + f""",
scored AS (
  SELECT t.fold AS h, (""" + " + ".join(f"u.f{k} * v.f{k}" for k in range(GD_D)) + f""") - t.rating AS err
  FROM folded t JOIN U{GD_ITERS} u ON u.h = t.fold AND t.user_id = u.id
  JOIN V{GD_ITERS} v ON v.h = t.fold AND t.item_id = v.id),
m AS (SELECT h, count(*) AS n_scored, sum(err * err) AS sse, sum(abs(err)) AS sae
      FROM scored GROUP BY h),
sizes AS (SELECT fold AS h, count(*) AS n_test FROM folded GROUP BY fold)""", """
SELECT CAST(s.h AS INTEGER) AS fold, CAST((SELECT count(*) FROM folded) - s.n_test AS BIGINT) AS n_train,
       CAST(s.n_test AS BIGINT) AS n_test, CAST(m.n_scored AS BIGINT) AS n_scored,
       round(sqrt(m.sse / m.n_scored), 6) AS rmse, round(m.sae / m.n_scored, 6) AS mae
FROM sizes s JOIN m ON s.h = m.h""")

# ---------------------------------------------------------------- step 5: evaluation, tuning
from .queries import EVAL_MIN_COUNTS, EVAL_REGS  # noqa: E402


def _pred_sql(reg: float, mc: int) -> str:
    shrunk = f"(s_train + {_dbl(reg)} * g_train) / (c_train + {_dbl(reg)})"
    if mc <= 0:
        return f"CASE WHEN c_train = 0 THEN NULL ELSE {shrunk} END"
    return f"CASE WHEN c_train < {int(mc)} THEN g_train ELSE {shrunk} END"


def runs_sql(regs, mcs) -> str:
    arms = []
    for reg in regs:
        for mc in mcs:
            err = f"({_pred_sql(reg, mc)}) - rating"
            arms.append(
                f"SELECT {_dbl(reg)} AS reg, CAST({int(mc)} AS INTEGER) AS min_count, fold, "
                f"count(*) AS n_test, count({err}) AS n_scored, sqrt(sum(({err}) * ({err})) / "
                f"count({err})) AS rmse, sum(abs({err})) / count({err}) AS mae "
                f"FROM evrows GROUP BY fold")
    return folded_cte() + f""",
per AS (SELECT item_id, fold, sum(rating) AS s, count(*) AS c FROM folded GROUP BY item_id, fold),
tot AS (SELECT item_id, sum(s) AS s_all, sum(c) AS c_all FROM per GROUP BY item_id),
stats AS (SELECT p.item_id, p.fold, t.s_all - p.s AS s_train, t.c_all - p.c AS c_train
          FROM per p JOIN tot t ON p.item_id = t.item_id),
pf AS (SELECT fold, sum(rating) AS s, count(*) AS c FROM folded GROUP BY fold),
allf AS (SELECT CAST(i AS INTEGER) AS fold FROM range({K_FOLDS}) t(i)),
pf2 AS (SELECT a.fold, coalesce(p.s, 0) AS s, coalesce(p.c, 0) AS c
        FROM allf a LEFT JOIN pf p ON a.fold = p.fold),
gmean AS (SELECT fold, (sum(s) OVER () - s) / (sum(c) OVER () - c) AS g_train FROM pf2),
evrows AS (SELECT f.fold, f.rating, st.s_train, coalesce(st.c_train, 0) AS c_train, g.g_train
           FROM folded f LEFT JOIN stats st ON f.item_id = st.item_id AND f.fold = st.fold
           JOIN gmean g ON f.fold = g.fold),
runs AS ({' UNION ALL '.join(arms)})"""


ORACLE["rmse_by_fold"] = with_base(runs_sql([0.0], [0]), """
SELECT fold, n_test, n_scored, round(rmse, 6) AS rmse FROM runs""")

ORACLE["mae_by_fold"] = with_base(runs_sql([0.0], [0]), """
SELECT fold, n_test, n_scored, round(mae, 6) AS mae FROM runs""")

_CV = runs_sql(EVAL_REGS, EVAL_MIN_COUNTS) + """,
cv AS (SELECT reg, min_count, avg(rmse) AS cv_rmse, count(*) AS n_folds FROM runs
       GROUP BY reg, min_count)"""

ORACLE["cv_error"] = with_base(_CV, """
SELECT reg, min_count, round(cv_rmse, 6) AS cv_rmse, n_folds FROM cv""")

ORACLE["best_params"] = with_base(_CV, """
SELECT reg, min_count, round(cv_rmse, 6) AS cv_rmse, n_folds FROM cv
WHERE cv_rmse <= (SELECT min(cv_rmse) + abs(min(cv_rmse)) * 1e-9 FROM cv)""")

ORACLE["tuning_curve"] = with_base(_CV, """
SELECT reg, round(cv_rmse, 6) AS cv_rmse FROM cv WHERE min_count = 1""")

# ---------------------------------------------------------------- step 6: factor text
from .queries import EXPORT_D  # noqa: E402

ORACLE["factor_export_rows"] = with_base(f"""
fx AS (SELECT id, {formula_cols(EXPORT_D)} FROM (SELECT DISTINCT user_id AS id FROM triples))""",
    "SELECT concat_ws(',', CAST(id AS VARCHAR), " + ", ".join(
        f"CAST(CAST(f{k} AS DECIMAL(38,12)) AS VARCHAR)" for k in range(EXPORT_D))
    + ") AS value FROM fx")

# ---------------------------------------------------------------- training: history, all rows, grid
from .queries import ALS_REG, GD_GRID_DS, GD_GRID_LAMS, GD_HISTORY_ITERS  # noqa: E402, F401


def _dot_sql(d: int) -> str:
    return " + ".join(f"u.f{k} * v.f{k}" for k in range(d))


def _norm_sql(d: int) -> str:
    return " + ".join(f"f{k} * f{k}" for k in range(d))


ORACLE["gd_history"] = with_base(folded_cte() + f""",
tr AS (SELECT user_id, item_id, rating FROM folded WHERE fold <> {HELD_OUT}),
te AS (SELECT user_id, item_id, rating FROM folded WHERE fold = {HELD_OUT}),
""" + gd_ctes("tr", GD_D, GD_HISTORY_ITERS, GD_LAM, GD_MU, GD_GAIN, GD_POWER), " UNION ALL ".join(f"""
SELECT CAST({i} AS INTEGER) AS iteration,
       round((SELECT sum(err * err) FROM J{i}) + {_dbl(GD_LAM)} * (SELECT sum({_norm_sql(GD_D)}) FROM U{i - 1})
             + {_dbl(GD_MU)} * (SELECT sum({_norm_sql(GD_D)}) FROM V{i - 1}), 6) AS objective,
       round({_dbl(GD_GAIN / i ** GD_POWER)}, 6) AS gamma,
       (SELECT count(*) FROM te) AS n_test, count(*) AS n_scored,
       round(sqrt(sum((({_dot_sql(GD_D)}) - t.rating) * (({_dot_sql(GD_D)}) - t.rating)) / count(*)), 6) AS test_rmse
FROM te t JOIN U{i - 1} u ON t.user_id = u.id JOIN V{i - 1} v ON t.item_id = v.id"""
    for i in range(1, GD_HISTORY_ITERS + 1)))

ORACLE["gd_train_all"] = with_base(_GDN + f""",
e AS (SELECT ({_dot_sql(GD_D)}) - t.rating AS err FROM triples t
      JOIN U{GD_ITERS} u ON t.user_id = u.id JOIN V{GD_ITERS} v ON t.item_id = v.id)""", """
SELECT count(*) AS n_train, round(sqrt(sum(err * err) / count(*)), 6) AS train_rmse,
       round(sum(abs(err)) / count(*), 6) AS train_mae
FROM e""")


def _gd_setting(lam: float, d: int) -> str:
    return f"""
SELECT * FROM (
WITH {gd_ctes("cvtrain", d, 1, lam, GD_MU, GD_GAIN, GD_POWER, part="h")},
m AS (
  SELECT t.fold AS h, count(*) AS n_scored, sum((({_dot_sql(d)}) - t.rating) * (({_dot_sql(d)}) - t.rating)) AS sse,
         sum(abs(({_dot_sql(d)}) - t.rating)) AS sae
  FROM folded t JOIN U1 u ON u.h = t.fold AND t.user_id = u.id JOIN V1 v ON v.h = t.fold AND t.item_id = v.id
  GROUP BY t.fold)
SELECT {_dbl(lam)} AS lam, {_dbl(GD_MU)} AS mu, CAST({d} AS INTEGER) AS d, CAST(s.h AS INTEGER) AS fold,
       CAST((SELECT count(*) FROM folded) - s.n_test AS BIGINT) AS n_train, CAST(s.n_test AS BIGINT) AS n_test,
       CAST(m.n_scored AS BIGINT) AS n_scored, round(sqrt(m.sse / m.n_scored), 6) AS rmse,
       round(m.sae / m.n_scored, 6) AS mae
FROM sizes s JOIN m ON s.h = m.h)"""


ORACLE["gd_grid"] = with_base(folded_cte() + f""",
cvtrain AS (SELECT CAST(h.i AS INTEGER) AS h, f.user_id, f.item_id, f.rating
            FROM folded f, range({K_FOLDS}) h(i) WHERE f.fold <> h.i),
sizes AS (SELECT fold AS h, count(*) AS n_test FROM folded GROUP BY fold)""",
    " UNION ALL ".join(_gd_setting(lam, d) for lam in GD_GRID_LAMS for d in GD_GRID_DS))

ORACLE["als_user_equations"] = with_base("", """
SELECT user_id, count(*) AS n_ratings, true AS ok FROM triples GROUP BY user_id""")

ORACLE["als_cv_counts"] = with_base(folded_cte() + """,
sizes AS (SELECT fold, count(*) AS n_test FROM folded GROUP BY fold),
users AS (SELECT user_id, min(fold) AS lo, max(fold) AS hi FROM folded GROUP BY user_id),
items AS (SELECT item_id, min(fold) AS lo, max(fold) AS hi FROM folded GROUP BY item_id),
seen AS (SELECT f.fold, count(*) AS n_scored FROM folded f
         JOIN users u ON f.user_id = u.user_id JOIN items i ON f.item_id = i.item_id
         WHERE (u.lo <> f.fold OR u.hi <> f.fold) AND (i.lo <> f.fold OR i.hi <> f.fold) GROUP BY f.fold)""", """
SELECT s.fold, CAST((SELECT count(*) FROM folded) - s.n_test AS BIGINT) AS n_train,
       CAST(s.n_test AS BIGINT) AS n_test, CAST(n.n_scored AS BIGINT) AS n_scored, true AS ordered
FROM sizes s JOIN seen n ON s.fold = n.fold""")

# ---------------------------------------------------------------- files: written and read back
ORACLE["reviews_round_trip"] = with_base("", """
SELECT user_name, item_id, item_name, category, round(rating, 6) AS rating FROM reviews""")
ORACLE["ratings_round_trip"] = with_base("", "SELECT user_id, item_id, rating FROM triples")
ORACLE["folds_round_trip"] = ORACLE["fold_assign"]
ORACLE["lookup_round_trip"] = ORACLE["item_lookup"]
ORACLE["factors_round_trip"] = with_base(f"""
fx AS (SELECT id, {formula_cols(EXPORT_D)} FROM (SELECT DISTINCT user_id AS id FROM triples))""",
    wide_long_sql("fx", "id", EXPORT_D))
ORACLE["runs_round_trip"] = with_base(runs_sql(EVAL_REGS, [0]), """
SELECT reg, fold, n_test, n_scored, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM runs""")

# ---------------------------------------------------------------- layouts, resumed work, checked files
from ..operators.gradient import GDParams  # noqa: E402
from .queries import ALS_GRID_REGS, GD_PACKED_D, GD_RESUMED_ITERS  # noqa: E402

ORACLE["similarity_top15_cells"] = ORACLE["similarity_top15"]
ORACLE["gd_train_blocks"] = ORACLE["gd_train"]
ORACLE["gd_grid_resume"] = ORACLE["gd_grid"]


def _last_factors(d: int, iters: int) -> str:
    ctes = gd_ctes("triples", d, iters, GD_LAM, GD_MU, GD_GAIN, GD_POWER).replace(" AS (SELECT", " AS MATERIALIZED (SELECT")
    return with_base(ctes, wide_long_sql(
        f"(SELECT 'user' AS side, * FROM U{iters} UNION ALL SELECT 'item' AS side, * FROM V{iters})", "side, id", d))


ORACLE["gd_train_packed"] = _last_factors(GD_PACKED_D, 1)
ORACLE["gd_resume"] = _last_factors(GD_D, GD_RESUMED_ITERS)

# the trainer's defaults: hashed start vectors, every step
_DEFAULT = GDParams()


def _hashed_start(side: str, col: str) -> str:
    fs = ", ".join(f"{hash_normal_sql(_DEFAULT.seed, side, k)} AS f{k}" for k in range(_DEFAULT.d))
    return f"(SELECT id, {fs} FROM (SELECT DISTINCT {col} AS id FROM triples))"


def _default_ctes() -> str:
    p = _DEFAULT
    steps = gd_ctes("triples", p.d, p.maxiter, p.lam, p.mu, p.gain, p.power).replace(" AS (SELECT", " AS MATERIALIZED (SELECT")
    first = [f"{name} AS MATERIALIZED {_hashed_start(side, col)}" for name, side, col in
             (("U0", "user", "user_id"), ("V0", "item", "item_id"))]
    return ",\n".join(first) + ",\n" + steps[steps.index("J1 AS"):]


ORACLE["gd_train_defaults"] = with_base(_default_ctes(), " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS iteration, round((SELECT sum(err * err) FROM J{i}) "
    f"+ {_dbl(_DEFAULT.lam)} * (SELECT sum({_norm_sql(_DEFAULT.d)}) FROM U{i - 1}) "
    f"+ {_dbl(_DEFAULT.mu)} * (SELECT sum({_norm_sql(_DEFAULT.d)}) FROM V{i - 1}), 3) AS objective"
    for i in range(1, _DEFAULT.maxiter + 1)))

_SAME = "true AS same_rows, true AS same_rmse, true AS same_mae"
ORACLE["als_cv_values"] = ORACLE["als_cv_counts"].replace("true AS ordered", _SAME)
ORACLE["als_train_all_values"] = with_base("", f"""
SELECT count(*) AS n_train, count(*) AS n_scored, {_SAME} FROM triples""")
ORACLE["als_train_defaults"] = ORACLE["als_train_all_values"]
ORACLE["als_grid_values"] = ORACLE["als_cv_values"].replace(
    "SELECT s.fold,", "SELECT g.reg, s.fold,").replace(
    "FROM sizes s JOIN seen n ON s.fold = n.fold",
    "FROM sizes s JOIN seen n ON s.fold = n.fold, (VALUES " + ", ".join(f"({_dbl(r)})" for r in ALS_GRID_REGS) + ") g(reg)")

ORACLE["ratings_checked"] = with_base("""
lines AS (
  SELECT CASE WHEN item_id % 10 IN (3, 7) THEN 'rejected' ELSE 'clean' END AS kind, *,
         CASE item_id % 10 WHEN 3 THEN concat_ws(',', user_id, item_id, 'n/a') WHEN 7 THEN concat_ws(',', user_id, item_id) END AS line
  FROM triples)""", """
SELECT kind, CASE WHEN line IS NULL THEN user_id END AS user_id, CASE WHEN line IS NULL THEN item_id END AS item_id,
       CASE WHEN line IS NULL THEN round(rating, 6) END AS rating, line, count(*) OVER (PARTITION BY kind) AS n
FROM lines""")
ORACLE["reviews_checked"] = with_base("", """
SELECT category, count(*) AS n, round(sum(rating), 6) AS rating FROM reviews WHERE item_id % 10 <> 3 GROUP BY category
UNION ALL SELECT '(rejected)', count(*), NULL FROM reviews WHERE item_id % 10 = 3""")
ORACLE["result_tables_round_trip"] = f"""
SELECT 'item' AS kind, item_id AS id, item_name AS name, distance AS value FROM ({ORACLE["nearest_items"]})
UNION ALL SELECT 'category', category_id, category, distance FROM ({ORACLE["nearest_categories"]})
UNION ALL SELECT 'top', item_id, item_name, rating FROM (
{ORACLE["top_items"].replace("FROM lookup WHERE", "FROM item_vectors WHERE")})"""

# ---------------------------------------------------------------- principal components
#: Squarings of the covariance: its power 2^40 leaves only the first component of it.
_SQUARINGS = 40


def _component(n: int) -> str:
    """CTEs of one component: powers by repeated squaring, the vector, and the covariance without it.

    A power's rows are multiples of the eigenvector; the row with the largest
    diagonal is taken, its sign fixed by its largest element.
    """
    return f"""
s{n} AS (
  SELECT 0 AS step, m FROM c{n}
  UNION ALL
  SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / top))
  FROM (SELECT step, q, list_max(list_transform(q, lambda r: list_max(list_transform(r, lambda x: abs(x))))) AS top
        FROM (SELECT step, list_transform(m, lambda r: list_transform(m, lambda c: list_inner_product(r, c))) AS q
              FROM s{n} WHERE step < {_SQUARINGS}))),
p{n} AS (SELECT m AS p FROM s{n} WHERE step = {_SQUARINGS}),
r{n} AS (
  SELECT r FROM (SELECT unnest(p) AS r, unnest(range(1, len(p) + 1)) AS i FROM p{n}) ORDER BY abs(r[i]) DESC LIMIT 1),
v{n} AS (
  SELECT list_transform(r, lambda x: x / sqrt(list_inner_product(r, r))
           * CASE WHEN list_max(r) >= -list_min(r) THEN {_dbl(1.0)} ELSE {_dbl(-1.0)} END) AS v FROM r{n}),
e{n} AS (SELECT v, list_inner_product(v, list_transform(m, lambda r: list_inner_product(r, v))) AS ev FROM c{n}, v{n}),
c{n + 1} AS (
  SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - ev * v[i] * v[j])) AS m FROM c{n}, e{n})"""


_PICKED = ORACLE["vectors_by_category"].split("picked AS (")[0].replace("WITH ", "WITH RECURSIVE ", 1) + """picked AS MATERIALIZED (
  SELECT b.item_id, b.category_id, CAST(b.position AS INTEGER) AS position, CAST(e.embedding AS DOUBLE[]) AS features
  FROM best b JOIN embeddings e ON b.item_id = e.vec_id)"""
ORACLE["pca_coords"] = _PICKED + """,
dims AS (SELECT item_id, i, features[i] AS x FROM (
  SELECT item_id, features, unnest(range(1, len(features) + 1)) AS i FROM picked)),
means AS (SELECT list(m ORDER BY i) AS mean FROM (SELECT i, avg(x) AS m FROM dims GROUP BY i)),
centred AS MATERIALIZED (
  SELECT item_id, category_id, position, list_transform(features, lambda x, i: x - mean[i]) AS x FROM picked, means),
long AS (SELECT item_id, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS x FROM centred),
products AS (
  SELECT a.i, b.i AS j, sum(a.x * b.x) / ((SELECT count(*) FROM centred) - 1) AS c
  FROM long a JOIN long b ON a.item_id = b.item_id GROUP BY a.i, b.i),
c1 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM products GROUP BY i)),""" + ",".join(
    _component(n) for n in (1, 2, 3)) + """
SELECT item_id, category_id, position, round(list_inner_product(x, v1.v), 6) AS pc1,
       round(list_inner_product(x, v2.v), 6) AS pc2, round(list_inner_product(x, v3.v), 6) AS pc3
FROM centred, v1, v2, v3"""
