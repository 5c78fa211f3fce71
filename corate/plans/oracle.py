"""Independent SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its answer from the raw benchmark tables with plain
joins, window functions and aggregates, so the Spark operators are checked
against a second engine rather than against themselves. Column names match
the Spark results; inexact doubles (predictions, RMSE) are rounded to 6 places
on both sides.

Weighted neighbour sums are folded in neighbour-rank order on both sides
(``list_reduce`` here, ``aggregate`` over a sorted list in Spark) so the two
engines add the same terms in the same order.
"""

from __future__ import annotations

# --- shared CTEs -----------------------------------------------------------

_BASE = {
    "ev": """
  SELECT o.o_custkey AS "user", l.l_partkey AS item,
         CAST(ceil(l.l_quantity / 5.0) AS DOUBLE) / 2.0 AS rating,
         l.l_orderkey, l.l_linenumber, l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "ratings": """
  SELECT "user", item, rating FROM (
    SELECT "user", item, rating,
           row_number() OVER (PARTITION BY "user", item
                              ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM ev) WHERE rn = 1""",
    "test": """
  SELECT "user", item FROM ev
  WHERE ("user" * 7 + item * 13) % 10 = 0 OR item % 97 = 0 OR "user" % 211 = 0
  UNION
  SELECT c.c_custkey AS "user", p.p_partkey AS item
  FROM customer c JOIN part p ON c.c_custkey = p.p_partkey
  WHERE c.c_custkey % 10 = 3""",
    "train": """
  SELECT r."user", r.item, r.rating FROM ratings r
  WHERE NOT EXISTS (SELECT 1 FROM test t WHERE t."user" = r."user" AND t.item = r.item)""",
    "truth": """
  SELECT r."user", r.item, r.rating FROM ratings r
  WHERE EXISTS (SELECT 1 FROM test t WHERE t."user" = r."user" AND t.item = r.item)""",
    "genres": """
  SELECT p_partkey AS item, p_brand AS genre FROM part""",
    "ustats": """
  SELECT "user", count(*) AS n_ratings, sum(rating) AS sum_rating, avg(rating) AS mean_rating
  FROM train GROUP BY "user\"""",
    "istats": """
  SELECT item, count(*) AS n_ratings, sum(rating) AS sum_rating, avg(rating) AS mean_rating
  FROM train GROUP BY item""",
    "gmean": """
  SELECT avg(rating) AS g FROM train""",
    # item-pair co-moments over co-raters, item1 < item2
    "imom": """
  SELECT a.item AS item1, b.item AS item2, count(*) AS n_corated,
         sum(a.rating) AS sx, sum(b.rating) AS sy, sum(a.rating * b.rating) AS sxy,
         sum(a.rating * a.rating) AS sxx, sum(b.rating * b.rating) AS syy
  FROM train a JOIN train b ON a."user" = b."user" AND a.item < b.item
  GROUP BY a.item, b.item""",
    "ipearson": """
  SELECT item1, item2, n_corated,
         CASE WHEN num <> 0 AND den <> 0 THEN num / den ELSE 0.0 END AS sim
  FROM (SELECT item1, item2, n_corated,
               CAST(n_corated AS DOUBLE) * sxy - sx * sy AS num,
               sqrt(greatest(CAST(n_corated AS DOUBLE) * sxx - sx * sx, 0.0))
                 * sqrt(greatest(CAST(n_corated AS DOUBLE) * syy - sy * sy, 0.0)) AS den
        FROM imom)""",
    "isumnorm": """
  SELECT item1, item2, n_corated,
         CASE WHEN sxy <> 0 AND sx * sy <> 0 THEN sxy / (sx * sy) ELSE 0.0 END AS sim
  FROM imom""",
    # n_u * (rating - mean_u): the user's deviation scaled by its count
    "centred": """
  SELECT t."user", t.item, t.rating, s.n_ratings, s.sum_rating,
         CAST(s.n_ratings AS DOUBLE) * t.rating - s.sum_rating AS dev
  FROM train t JOIN ustats s ON t."user" = s."user\"""",
    "upearson": """
  SELECT user1, user2, n_common,
         CASE WHEN sab <> 0 AND sqrt(saa) * sqrt(sbb) <> 0
              THEN sab / (sqrt(saa) * sqrt(sbb)) ELSE 0.0 END AS sim
  FROM (SELECT a."user" AS user1, b."user" AS user2, count(*) AS n_common,
               sum(a.dev * b.dev) AS sab, sum(a.dev * a.dev) AS saa, sum(b.dev * b.dev) AS sbb
        FROM centred a JOIN centred b ON a.item = b.item AND a."user" < b."user"
        GROUP BY a."user", b."user")""",
    "ugenre": """
  SELECT t."user", g.genre, count(*) AS n_ratings, avg(t.rating) AS mean_rating
  FROM train t JOIN genres g ON t.item = g.item
  GROUP BY t."user", g.genre""",
    "cold": """
  SELECT t."user", t.item, t.rating,
         CASE WHEN u."user" IS NULL AND i.item IS NULL THEN 'cold_both'
              WHEN u."user" IS NULL THEN 'cold_user' ELSE 'cold_item' END AS reason
  FROM truth t
  LEFT JOIN (SELECT DISTINCT "user" FROM train) u ON t."user" = u."user"
  LEFT JOIN (SELECT DISTINCT item FROM train) i ON t.item = i.item
  WHERE u."user" IS NULL OR i.item IS NULL""",
}

# Ratings off any grid, and Pearson by its definition: centred first, then
# multiplied; constant series and vanishing covariances read as 0.
_OFFGRID_EVENTS = """
  SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_extendedprice / 19997.0 AS rating,
         l.l_orderkey, l.l_linenumber, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
_TWO_PASS = """
  SELECT item1, item2, n_corated,
         CASE WHEN flat OR abs(num) <= 1e-12 * den THEN 0.0 ELSE num / den END AS sim
  FROM (SELECT item1, item2, count(*) AS n_corated,
               min(x) = max(x) OR min(y) = max(y) AS flat,
               sum((x - mx) * (y - my)) AS num,
               sqrt(sum((x - mx) * (x - mx))) * sqrt(sum((y - my) * (y - my))) AS den
        FROM (SELECT a.item AS item1, b.item AS item2, a.rating AS x, b.rating AS y,
                     avg(a.rating) OVER w AS mx, avg(b.rating) OVER w AS my
              FROM train a JOIN train b ON a."user" = b."user" AND a.item < b.item
              WINDOW w AS (PARTITION BY a.item, b.item))
        GROUP BY item1, item2)"""

# Order the CTEs may appear in (each only uses earlier ones).
_ORDER = [
    "ev", "ratings", "test", "train", "truth", "genres", "ustats", "istats", "gmean",
    "imom", "ipearson", "isumnorm", "centred", "upearson", "ugenre", "cold",
]

_DEPS = {
    "ratings": ["ev"],
    "test": ["ev"],
    "train": ["ratings", "test"],
    "truth": ["ratings", "test"],
    "ustats": ["train"],
    "istats": ["train"],
    "gmean": ["train"],
    "imom": ["train"],
    "ipearson": ["imom"],
    "isumnorm": ["imom"],
    "centred": ["train", "ustats"],
    "upearson": ["centred"],
    "ugenre": ["train", "genres"],
    "cold": ["truth", "train"],
}


def _closure(names: list[str]) -> list[str]:
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _DEPS.get(n, []):
            visit(d)
        seen.add(n)

    for n in names:
        visit(n)
    return [n for n in _ORDER if n in seen]


def with_ctes(uses: list[str], extra: list[tuple[str, str]], select: str) -> str:
    parts = [f"{n} AS ({_BASE[n]}\n)" for n in _closure(uses)]
    parts += [f"{n} AS ({body}\n)" for n, body in extra]
    return "WITH " + ",\n".join(parts) + "\n" + select


# --- neighbour pipelines ---------------------------------------------------

def _item_top(sim_cte: str, k: int) -> list[tuple[str, str]]:
    return [
        ("icand", f"""
  SELECT t."user", t.item, t.rating, r.item AS nbr, r.rating AS nbr_rating
  FROM truth t JOIN train r ON t."user" = r."user\""""),
        ("iscored", f"""
  SELECT c.*, coalesce(s.sim, 0.0) AS sim
  FROM icand c LEFT JOIN {sim_cte} s
    ON s.item1 = least(c.item, c.nbr) AND s.item2 = greatest(c.item, c.nbr)"""),
        ("itop", f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "user", item ORDER BY sim DESC, nbr ASC) AS nbr_rank
    FROM iscored) WHERE nbr_rank <= {k}"""),
    ]


def _user_top(k: int) -> list[tuple[str, str]]:
    return [
        ("ucand", """
  SELECT t."user", t.item, t.rating, c."user" AS nbr, c.rating AS nbr_rating,
         c.n_ratings AS nbr_n, c.sum_rating AS nbr_sum
  FROM truth t JOIN centred c ON t.item = c.item"""),
        ("uscored", """
  SELECT c.*, coalesce(s.sim, 0.0) AS sim
  FROM ucand c LEFT JOIN upearson s
    ON s.user1 = least(c."user", c.nbr) AND s.user2 = greatest(c."user", c.nbr)"""),
        ("utop", f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "user", item ORDER BY sim DESC, nbr ASC) AS nbr_rank
    FROM uscored) WHERE nbr_rank <= {k}"""),
    ]


def _folded(top: str, weighted: str) -> tuple[str, str]:
    return ("agg", f"""
  SELECT "user", item,
         list_reduce(list({weighted} ORDER BY nbr_rank), lambda a, b: a + b) AS num,
         list_reduce(list(abs(sim) ORDER BY nbr_rank), lambda a, b: a + b) AS den,
         count(*) AS n_neighbors
  FROM {top} GROUP BY "user", item""")


def _item_predictions(sim_cte: str, k: int, genre_fallback: bool, rounded: bool) -> str:
    uses = ["truth", "train", "ustats", "gmean", sim_cte]
    extra = _item_top(sim_cte, k) + [_folded("itop", "nbr_rating * sim")]
    ok = "a.num <> 0 AND a.den <> 0"
    gm_case = gm_src = gm_join = ""
    if genre_fallback:
        uses += ["genres", "ugenre"]
        gm_join = """
  LEFT JOIN genres g ON g.item = t.item
  LEFT JOIN ugenre ug ON ug."user" = t."user" AND ug.genre = g.genre"""
        gm_case = "WHEN ug.mean_rating IS NOT NULL THEN ug.mean_rating"
        gm_src = "WHEN ug.mean_rating IS NOT NULL THEN 'genre_mean'"
    pred = f"""CASE WHEN {ok} THEN a.num / a.den {gm_case}
              WHEN s.mean_rating IS NOT NULL THEN s.mean_rating
              ELSE (SELECT g FROM gmean) END"""
    if rounded:
        pred = f"round({pred}, 6)"
    extra.append(("pred", f"""
  SELECT t."user", t.item, t.rating,
         {pred} AS prediction,
         CASE WHEN {ok} THEN 'neighbors' {gm_src}
              WHEN s.mean_rating IS NOT NULL THEN 'user_mean'
              ELSE 'global_mean' END AS source,
         coalesce(a.n_neighbors, 0) AS n_neighbors
  FROM truth t
  LEFT JOIN agg a ON a."user" = t."user" AND a.item = t.item
  LEFT JOIN ustats s ON s."user" = t."user"{gm_join}"""))
    return uses, extra


def _user_predictions(k: int, loo: str, rounded: bool):
    if loo == "literal":
        dev = "(nbr_rating - ((nbr_sum - nbr_rating) / CAST(nbr_n AS DOUBLE) - 1.0))"
    else:
        dev = ("(CASE WHEN nbr_n > 1 THEN nbr_rating - (nbr_sum - nbr_rating) "
               "/ (CAST(nbr_n AS DOUBLE) - 1.0) ELSE 0.0 END)")
    uses = ["truth", "train", "ustats", "gmean", "centred", "upearson"]
    extra = _user_top(k) + [_folded("utop", f"{dev} * sim")]
    ok = "a.num <> 0 AND a.den <> 0 AND s.mean_rating IS NOT NULL"
    pred = f"""CASE WHEN {ok} THEN s.mean_rating + a.num / a.den
              WHEN s.mean_rating IS NOT NULL THEN s.mean_rating
              ELSE (SELECT g FROM gmean) END"""
    if rounded:
        pred = f"round({pred}, 6)"
    extra.append(("pred", f"""
  SELECT t."user", t.item, t.rating,
         {pred} AS prediction,
         CASE WHEN {ok} THEN 'neighbors'
              WHEN s.mean_rating IS NOT NULL THEN 'user_mean'
              ELSE 'global_mean' END AS source,
         coalesce(a.n_neighbors, 0) AS n_neighbors
  FROM truth t
  LEFT JOIN agg a ON a."user" = t."user" AND a.item = t.item
  LEFT JOIN ustats s ON s."user" = t."user\""""))
    return uses, extra


_EVAL_SELECT = """
SELECT count(*) FILTER (WHERE e >= 0 AND e < 1) AS band_0_1,
       count(*) FILTER (WHERE e >= 1 AND e < 2) AS band_1_2,
       count(*) FILTER (WHERE e >= 2 AND e < 3) AS band_2_3,
       count(*) FILTER (WHERE e >= 3 AND e < 4) AS band_3_4,
       count(*) FILTER (WHERE e >= 4) AS band_4_up,
       count(*) AS n_scored,
       round(sqrt(avg(e * e)), 6) AS rmse
FROM (SELECT abs(rating - prediction) AS e FROM pred)"""

_PRED_SELECT = 'SELECT "user", item, rating, prediction, source, n_neighbors FROM pred'


def _impute_sql(how: str) -> str:
    if how == "genre":
        uses = ["cold", "train", "genres", "ugenre", "ustats", "gmean"]
        first = """
  LEFT JOIN genres g ON g.item = c.item
  LEFT JOIN ugenre f ON f."user" = c."user" AND f.genre = g.genre"""
        label = "genre_mean"
    else:
        uses = ["cold", "train", "istats", "ustats", "gmean"]
        first = """
  LEFT JOIN istats f ON f.item = c.item"""
        label = "item_mean"
    return with_ctes(uses, [], f"""
SELECT c."user", c.item, c.rating,
       coalesce(f.mean_rating, s.mean_rating, (SELECT g FROM gmean)) AS prediction,
       CASE WHEN f.mean_rating IS NOT NULL THEN '{label}'
            WHEN s.mean_rating IS NOT NULL THEN 'user_mean'
            ELSE 'global_mean' END AS source
FROM cold c{first}
  LEFT JOIN ustats s ON s."user" = c."user\"""")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_dedup"] = with_ctes(["ratings"], [], 'SELECT "user", item, rating FROM ratings')
    q["test_pairs"] = with_ctes(["test"], [], 'SELECT "user", item FROM test')
    q["train_split"] = with_ctes(["train"], [], 'SELECT "user", item, rating FROM train')
    q["truth_holdout"] = with_ctes(["truth"], [], 'SELECT "user", item, rating FROM truth')
    q["user_stats"] = with_ctes(["ustats"], [], "SELECT * FROM ustats")
    q["item_stats"] = with_ctes(["istats"], [], "SELECT * FROM istats")
    q["user_item_lists"] = with_ctes(["train"], [], """
SELECT "user", CAST(floor(item / 1000) AS BIGINT) AS item_block, count(*) AS n_members,
       string_agg(CAST(item AS VARCHAR), ' ' ORDER BY item) AS members
FROM train GROUP BY "user", CAST(floor(item / 1000) AS BIGINT)""")
    q["item_user_lists"] = with_ctes(["train"], [], """
SELECT item, CAST(floor("user" / 1000) AS BIGINT) AS user_block, count(*) AS n_members,
       string_agg(CAST("user" AS VARCHAR), ' ' ORDER BY "user") AS members
FROM train GROUP BY item, CAST(floor("user" / 1000) AS BIGINT)""")
    q["corated_pairs"] = with_ctes(["ipearson"], [], "SELECT item1, item2, n_corated, sim FROM ipearson")
    q["corated_pair_count"] = with_ctes(["imom"], [], "SELECT count(*) AS n_pairs FROM imom")
    q["item_pearson"] = with_ctes(["truth", "train", "ipearson"], [("needed", """
  SELECT DISTINCT least(t.item, r.item) AS item1, greatest(t.item, r.item) AS item2
  FROM truth t JOIN train r ON t."user" = r."user\"""")], """
SELECT n.item1, n.item2, coalesce(s.n_corated, 0) AS n_corated, coalesce(s.sim, 0.0) AS sim
FROM needed n LEFT JOIN ipearson s ON s.item1 = n.item1 AND s.item2 = n.item2""")
    q["item_sum_normalized"] = with_ctes(["isumnorm"], [], "SELECT item1, item2, n_corated, sim FROM isumnorm")
    q["user_pearson"] = with_ctes(["upearson"], [], "SELECT user1, user2, n_common, sim FROM upearson")
    q["user_genre_mean"] = with_ctes(["ugenre"], [], "SELECT * FROM ugenre")

    q["topk_items"] = with_ctes(
        ["truth", "train", "ipearson"], _item_top("ipearson", 10),
        'SELECT "user", item, nbr, nbr_rating, sim, nbr_rank FROM itop')
    q["topk_users"] = with_ctes(
        ["truth", "train", "centred", "upearson"], _user_top(1),
        'SELECT "user", item, nbr, nbr_rating, sim, nbr_rank FROM utop')

    u, e = _item_predictions("ipearson", 10, False, True)
    q["item_based_predict"] = with_ctes(u, e, _PRED_SELECT)
    u, e = _item_predictions("ipearson", 10, False, False)
    q["item_based_eval"] = with_ctes(u, e, _EVAL_SELECT)
    u, e = _item_predictions("isumnorm", 10, False, True)
    q["item_based_sum_normalized_predict"] = with_ctes(u, e, _PRED_SELECT)
    u, e = _item_predictions("ipearson", 10, True, True)
    q["item_based_genre_fallback"] = with_ctes(u, e, _PRED_SELECT)
    u, e = _item_predictions("ipearson", 10, False, True)
    q["prediction_output"] = with_ctes(
        u, e, 'SELECT "user" AS "UserId", item AS "MovieId", prediction AS "Pred_rating" FROM pred')

    u, e = _user_predictions(1, "literal", True)
    q["user_based_predict"] = with_ctes(u, e, _PRED_SELECT)
    u, e = _user_predictions(1, "corrected", True)
    q["user_based_predict_corrected"] = with_ctes(u, e, _PRED_SELECT)
    u, e = _user_predictions(1, "literal", False)
    q["user_based_eval"] = with_ctes(u, e, _EVAL_SELECT)

    q["cold_start_cases"] = with_ctes(["cold"], [], 'SELECT "user", item, rating, reason FROM cold')
    q["impute_genre"] = _impute_sql("genre")
    q["impute_item_mean"] = _impute_sql("item_mean")
    q["model_based_imputed"] = _impute_sql("genre")
    q["als_coverage"] = with_ctes(["test", "train"], [], """
SELECT t."user", t.item FROM test t
WHERE t."user" IN (SELECT "user" FROM train) AND t.item IN (SELECT item FROM train)""")
    q["model_based_keys"] = (
        "WITH scored AS (" + q["als_coverage"] + "),\nfilled AS (" + _impute_sql("genre") + ")\n"
        + """SELECT "user", item, 'als' AS source, CAST(NULL AS DOUBLE) AS imputed FROM scored
UNION ALL SELECT "user", item, source, prediction FROM filled""")
    q["als_dot_check"] = "SELECT *, true AS is_dot_product FROM (" + q["als_coverage"] + ")"
    q["als_normal_equations"] = with_ctes(["train"], [], 'SELECT DISTINCT "user", true AS solved FROM train')
    q["als_user_half_step"] = with_ctes(["train"], [], 'SELECT DISTINCT "user", true AS same FROM train')
    q["als_item_half_step"] = with_ctes(["train"], [], "SELECT DISTINCT item, true AS solved FROM train")
    q["als_fold_in"] = with_ctes(["truth", "train"], [], """
SELECT DISTINCT t."user", true AS solved FROM truth t
WHERE t."user" NOT IN (SELECT "user" FROM train) AND t.item IN (SELECT item FROM train)""")
    dot = " + ".join(f'("user" * {2 * k + 3}) % 11 / 8.0::DOUBLE * ((item * {2 * k + 5}) % 13 / 8.0::DOUBLE)' for k in range(5))
    formula = (f'SELECT "user", item, {dot} AS prediction, \'als\' AS source FROM (' + q["als_coverage"] + ")"
               + ' UNION ALL SELECT "user", item, prediction, source FROM (' + _impute_sql("genre") + ")")
    q["model_based_formula_predict"] = f"SELECT * FROM ({formula})"
    q["model_based_formula_eval"] = with_ctes(["truth"], [("model", formula), ("pred", """
  SELECT t.rating, m.prediction FROM truth t JOIN model m ON m."user" = t."user" AND m.item = t.item""")], _EVAL_SELECT)
    q["score_join_eval"] = with_ctes(["truth", "test", "ustats", "gmean"], [("pred", """
  SELECT h."user", h.item, h.rating, coalesce(s.mean_rating, (SELECT g FROM gmean)) AS prediction
  FROM truth h JOIN test t ON t."user" = h."user" AND t.item = h.item
  LEFT JOIN ustats s ON s."user" = h."user\"""")], _EVAL_SELECT)

    off = lambda sql: sql.replace(_BASE["ev"], _OFFGRID_EVENTS).replace(_BASE["ipearson"], _TWO_PASS)
    off_order = lambda sql: sql.replace("l_quantity DESC", "l_extendedprice DESC")
    q["item_pearson_offgrid"] = off_order(off(with_ctes(
        ["ipearson"], [], "SELECT item1, item2, n_corated, round(sim, 12) + 0.0 AS sim FROM ipearson")))
    u, e = _item_predictions("ipearson", 1_000_000, False, True)
    q["item_based_offgrid_predict"] = off_order(off(with_ctes(
        u, e, 'SELECT "user", item, round(rating, 6) AS rating, prediction, source, n_neighbors FROM pred')))

    q["csv_ratings"] = q["ratings_dedup"]
    q["csv_test_pairs"] = q["test_pairs"]
    q["csv_genres"] = with_ctes(["genres"], [], "SELECT item, genre FROM genres")
    q["csv_header_parts"] = with_ctes(["ratings"], [], """
SELECT e."user", e.item, count(*) AS n_lines, max(r.rating) AS rating
FROM ev e JOIN ratings r ON r."user" = e."user" AND r.item = e.item GROUP BY e."user", e.item""")
    q["csv_rejects"] = """
SELECT 'ratings' AS file, 'x' || user_id || ',none,3.5,' || user_id AS line, 'type' AS reason FROM events
UNION ALL SELECT 'ratings', r_regionkey || ',1,3.5,9,extra', 'fields' FROM region
UNION ALL SELECT 'ratings', r_regionkey || ',1,2.5', 'fields' FROM region
UNION ALL SELECT 'ratings', '"' || r_regionkey || ',1,3.0,4', 'quote' FROM region
UNION ALL SELECT 'test', s_suppkey || ',none', 'type' FROM supplier
UNION ALL SELECT 'genres', n_name || ',"Nation, A",none', 'type' FROM nation"""
    q["prediction_file"] = (
        'SELECT row_number() OVER (ORDER BY "UserId", "MovieId") AS position, * FROM (' + q["prediction_output"] + ")")
    q["prediction_single_file"] = q["prediction_file"]
    return q
