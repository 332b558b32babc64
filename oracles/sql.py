"""DuckDB SQL for every query, written the plain way the statistics are defined.

Effects are refitted row by row, stage after stage, with one join per stage; penalties are tried
one by one.  It shares no algebra with the Spark code, so agreement checks that algebra.
"""

from __future__ import annotations

import re

from residua.operators.knn import K_GRID, RESAMPLES
from residua.operators.split import REJECTED, TEST, TRAIN
from residua.plans.queries import NOISE_DECIMALS, SHOWN_DECIMALS, SMALL_K, SWEPT_STAGE
from residua.plans.tuning import PENALTIES
from residua.plans.workspace import PANEL_SIZE, PANELS, SAMPLED_USERS, UNKNOWN_EVERY
from residua.specs import VIEW_PLAIN, VIEW_SHRUNK, Spec, Stage

_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> str:
    _CTES[name] = sql
    return name


def build(final: str) -> str:
    """``final`` after a WITH of every named part it needs, in order of need."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"\b[a-z_0-9]+\b", sql):
            if word in _CTES and word not in needed:
                visit(_CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(final)
    parts = [f"{name} AS MATERIALIZED (\n{_CTES[name]}\n)" for name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def shown(expression: str, name: str) -> str:
    plain = f"CAST({expression} AS DECIMAL(38, {NOISE_DECIMALS}))"
    return f"CAST(round({plain}, {SHOWN_DECIMALS}) AS DOUBLE) + 0.0::DOUBLE AS {name}"


# --- the rows

cte(
    "v_items",
    """SELECT p_partkey AS item_id,
  CASE WHEN p_partkey % 97 = 0 THEN p_name
       ELSE p_name || ' (' || CAST(1930 + (p_partkey * 7) % 80 AS VARCHAR) || ')' END AS title,
  concat_ws('|', p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS tags
FROM part""",
)
LINE_KEY = """md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))))"""
FILE_KEY = """md5(concat_ws('|', o_custkey, l_partkey, ceil(l_quantity / 5.0::DOUBLE) / 2.0::DOUBLE,
    date_diff('second', TIMESTAMP '1970-01-01', l_shipdate)))"""
cte(
    "v_rows",
    f"""SELECT {LINE_KEY} AS rating_key,
  o_custkey AS user_id, l_partkey AS item_id,
  ceil(l_quantity / 5.0::DOUBLE) / 2.0::DOUBLE AS rating,
  CAST(date_diff('second', TIMESTAMP '1970-01-01', l_shipdate) AS BIGINT) AS ts, title, tags
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN v_items ON l_partkey = item_id""",
)
cte(
    "v_rows_year",
    r"""SELECT *, TRY_CAST(nullif(regexp_extract(title, '(\d{4})\)$', 1), '') AS INTEGER) AS year,
  CAST(to_timestamp(ts) AT TIME ZONE 'UTC' AS DATE) AS date FROM v_rows""",
)
ROW = "rating_key, user_id, item_id, rating, ts, title, tags"
NARROW = "rating_key, user_id, item_id, rating, ts"


# --- splits


def add_split(name: str, source: str, salt: str, rejected: str) -> None:
    cte(
        f"{name}_edges",
        f"""SELECT quantile_cont(rating, 0.0) AS q0, quantile_cont(rating, 0.25) AS q1,
  quantile_cont(rating, 0.5) AS q2, quantile_cont(rating, 0.75) AS q3,
  quantile_cont(rating, 1.0) AS q4, count(*) AS n FROM {source}""",
    )
    cte(
        f"{name}_marked",
        f"""SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h)
    <= ceil(0.1::DOUBLE * count(*) OVER (PARTITION BY stratum)) AS held_out
FROM (SELECT {ROW}, md5(concat_ws('|', '{salt}', rating_key)) AS h,
    CAST(q1 > q0 AND q1 < q4 AND rating > q1 AS INTEGER)
    + CAST(q2 > q1 AND q2 < q4 AND q2 > q0 AND rating > q2 AS INTEGER)
    + CAST(q3 > q2 AND q3 < q4 AND q3 > q0 AND rating > q3 AS INTEGER) AS stratum
  FROM {source}, {name}_edges)""",
    )
    cte(
        name,
        f"""SELECT {ROW}, CASE WHEN NOT held_out THEN '{TRAIN}'
    WHEN item_id IN (SELECT item_id FROM {name}_marked WHERE NOT held_out)
     AND user_id IN (SELECT user_id FROM {name}_marked WHERE NOT held_out) THEN '{TEST}'
    ELSE '{rejected}' END AS fold
FROM {name}_marked""",
    )
    for fold in (TRAIN, TEST):
        cte(f"{name}_{fold}", f"SELECT {ROW} FROM {name} WHERE fold = '{fold}'")


add_split("s_outer", "v_rows", "outer", TRAIN)
add_split("s_inner", "s_outer_train", "inner", REJECTED)
add_split("s_tuning", "s_inner_train", "tuning", REJECTED)


# --- effects, stage after stage


def add_tag_stages(prefix: str, rows: str, stages: list[tuple[Stage, str]], user: str) -> str:
    """Residual rows after the stages; each stage leaves ``<prefix>_tag_<i>``."""
    current = rows
    for i, (stage, penalty) in enumerate(stages):
        cte(
            f"{prefix}_tag_{i}",
            f"""SELECT user_id, '{stage.name}' AS tag, '{stage.token}' AS token,
  sum(e) / (count(*) + {penalty}) AS b, count(*) AS n
FROM {current} WHERE contains(tags, '{stage.token}') GROUP BY user_id""",
        )
        cte(f"{prefix}_e_{i}", subtract_tag(current, f"{prefix}_tag_{i}", stage))
        current = f"{prefix}_e_{i}"
    return current


def subtract_tag(rows: str, effect: str, stage: Stage) -> str:
    return f"""SELECT x.* EXCLUDE (e),
  x.e - CASE WHEN contains(x.tags, '{stage.token}') THEN coalesce(t.b, 0.0::DOUBLE) ELSE 0.0::DOUBLE END AS e
FROM {rows} x LEFT JOIN {effect} t ON x.user_id = t.user_id"""


def double(value: float) -> str:
    return f"{float(value)!r}::DOUBLE"


cte("v_mu", "SELECT avg(rating) AS mu FROM s_inner_train")


cte("u_rows", f"SELECT * FROM v_rows WHERE (user_id + item_id) % {UNKNOWN_EVERY} <> 0")
cte("u_mu", "SELECT avg(rating) AS mu FROM u_rows")


def add_model(spec: Spec, rows: str = "s_inner_train", mu: str = "v_mu", prefix: str = "") -> None:
    p = prefix + spec.name
    cte(
        f"{p}_item",
        f"""SELECT item_id, sum(rating - mu) / (count(*) + {double(spec.item_penalty)}) AS b_i, count(*) AS n
FROM {rows}, {mu} GROUP BY item_id""",
    )
    cte(
        f"{p}_user",
        f"""SELECT user_id, sum(rating - mu - b_i) / (count(*) + {double(spec.user_penalty)}) AS b_u, count(*) AS n
FROM {rows} JOIN {p}_item USING (item_id), {mu} GROUP BY user_id""",
    )
    cte(
        f"{p}_start",
        f"""SELECT {ROW}, rating - mu - b_i - b_u AS e
FROM {rows} JOIN {p}_item USING (item_id) JOIN {p}_user USING (user_id), {mu}""",
    )
    last = add_tag_stages(p, f"{p}_start", [(s, double(s.penalty)) for s in spec.stages], f"{p}_user")
    cte(f"{p}_left", f"SELECT * FROM {last}")
    cte(
        f"{p}_tags",
        " UNION ALL ".join(f"SELECT * FROM {p}_tag_{i}" for i in range(len(spec.stages))),
    )


add_model(VIEW_PLAIN)
add_model(VIEW_SHRUNK)
add_model(VIEW_SHRUNK, "u_rows", "u_mu", "u_")
cte("t_rows", "SELECT * FROM s_inner_train WHERE user_id % 5 <> 0 AND item_id % 7 <> 0")
cte("t_mu", "SELECT avg(rating) AS mu FROM t_rows")
add_model(VIEW_SHRUNK, "t_rows", "t_mu", "t_")

cte("shrunk_fitted", "SELECT *, rating - e AS pred, e AS residual FROM shrunk_left")
cte(
    "years",
    r"""SELECT TRY_CAST(nullif(regexp_extract(title, '(\d{4})\)$', 1), '') AS INTEGER) AS year,
  avg(residual) AS b, count(*) AS n FROM shrunk_fitted GROUP BY 1""",
)


# --- smoothing

cte(
    "year_points",
    """SELECT row_number() OVER (ORDER BY year, n) - 1 AS place, year, n, b
FROM years WHERE year IS NOT NULL""",
)
cte(
    "k_draws",
    f"""SELECT r AS resample, ('0x' || substr(md5(concat_ws('|', 'boot', r, place)), 1, 15))::BIGINT
    % (SELECT count(*) FROM year_points) AS place
FROM year_points, range(1, {RESAMPLES + 1}) t(r)""",
)
cte(
    "k_ranked",
    f"""SELECT o.resample, o.place, o.b AS truth, g.b AS value,
  rank() OVER (PARTITION BY o.resample, o.place
    ORDER BY (o.year - g.year)::DOUBLE * (o.year - g.year) + (o.n - g.n)::DOUBLE * (o.n - g.n)) AS r
FROM (SELECT t.r AS resample, p.* FROM year_points p, range(1, {RESAMPLES + 1}) t(r)
      WHERE NOT EXISTS (SELECT 1 FROM k_draws d WHERE d.resample = t.r AND d.place = p.place)) o
JOIN k_draws d ON d.resample = o.resample JOIN year_points g ON g.place = d.place""",
)
cte(
    "k_tried",
    f"""SELECT k, avg(rmse) AS rmse FROM (
  SELECT k, resample, sqrt(avg((pred - truth) * (pred - truth))) AS rmse FROM (
    SELECT k, resample, place, any_value(truth) AS truth, avg(value) AS pred
    FROM k_ranked, (SELECT unnest({list(K_GRID)})::INTEGER AS k) WHERE r <= k GROUP BY ALL)
  GROUP BY k, resample) GROUP BY k""",
)
cte("k_best", "SELECT k, rmse FROM k_tried ORDER BY rmse, k LIMIT 1")


def smoothed(k: str, with_n: bool = True) -> str:
    by_n = " + (q.n - g.n)::DOUBLE * (q.n - g.n)" if with_n else ""
    return f"""SELECT y.year, y.b, y.n, s.knn FROM years y LEFT JOIN (
  SELECT year, avg(value) AS knn FROM (
    SELECT q.year, g.b AS value, rank() OVER (PARTITION BY q.year
      ORDER BY (q.year - g.year)::DOUBLE * (q.year - g.year){by_n}) AS r
    FROM year_points q, year_points g) WHERE r <= {k} GROUP BY year) s ON y.year = s.year"""


cte("year_smooth", smoothed("(SELECT k FROM k_best)"))


# --- scores


def tag_sum(spec: str, rows: str) -> str:
    return f"""SELECT rating_key, sum(b) AS b_tags FROM {rows} x JOIN {spec}_tags t
  ON x.user_id = t.user_id AND contains(x.tags, t.token) GROUP BY rating_key"""


for _rows, _name in (("s_inner_test", "test"), ("s_outer_test", "validation")):
    cte(
        f"parts_{_name}",
        f"""SELECT x.rating_key, x.rating, mu, pi.b_i AS pi, pu.b_u AS pu, si.b_i AS si, su.b_u AS su,
  coalesce(pt.b_tags, 0.0::DOUBLE) AS pt, coalesce(st.b_tags, 0.0::DOUBLE) AS st, y.knn AS knn
FROM {_rows} x CROSS JOIN v_mu
LEFT JOIN plain_item pi ON x.item_id = pi.item_id LEFT JOIN plain_user pu ON x.user_id = pu.user_id
LEFT JOIN shrunk_item si ON x.item_id = si.item_id LEFT JOIN shrunk_user su ON x.user_id = su.user_id
LEFT JOIN ({tag_sum("plain", _rows)}) pt ON x.rating_key = pt.rating_key
LEFT JOIN ({tag_sum("shrunk", _rows)}) st ON x.rating_key = st.rating_key
LEFT JOIN v_rows_year r ON x.rating_key = r.rating_key
LEFT JOIN year_smooth y ON r.year IS NOT DISTINCT FROM y.year""",
    )

PREDICTIONS = {
    "average": "mu",
    "item": "mu + pi",
    "item + user": "mu + pi + pu",
    "item + user + tags": "mu + pi + pu + pt",
    "shrunk item + user + tags": "mu + si + su + st",
    "shrunk item + user + tags + year": "mu + si + su + st + knn",
}
THIN_KNOWN = "item_id IN (SELECT item_id FROM t_rows) AND user_id IN (SELECT user_id FROM t_rows)"
cte(
    "t_parts",
    f"""SELECT x.rating_key, x.rating, mu, si.b_i AS si, su.b_u AS su, coalesce(st.b_tags, 0.0::DOUBLE) AS st
FROM s_inner_test x CROSS JOIN t_mu
LEFT JOIN t_shrunk_item si ON x.item_id = si.item_id LEFT JOIN t_shrunk_user su ON x.user_id = su.user_id
LEFT JOIN ({tag_sum("t_shrunk", "s_inner_test")}) st ON x.rating_key = st.rating_key""",
)
FILLED = "mu + coalesce(si, 0.0::DOUBLE) + coalesce(su, 0.0::DOUBLE) + st"


def scored(rows: str, prediction: str) -> str:
    return build(f"SELECT rating_key, rating, {shown(prediction, 'pred')} FROM {rows}")


def rmse(prediction: str) -> str:
    return f"sqrt(avg((rating - ({prediction})) * (rating - ({prediction}))))"


def whole_rmse(prediction: str) -> str:
    return f"CASE WHEN count({prediction}) = count(*) THEN {rmse(prediction)} END"


def board(rows: str, predictions: list[tuple[str, str]]) -> str:
    return build(
        " UNION ALL ".join(
            f"SELECT {i} AS place, '{method}' AS method, {shown(whole_rmse(p), 'rmse')}, "
            f"{shown('round(' + whole_rmse(p) + ', 4)', 'rmse_4')}, "
            f"{shown(rmse(p), 'rmse_scored')}, count({p}) AS scored, count(*) - count({p}) AS missing "
            f"FROM {rows}"
            for i, (method, p) in enumerate(predictions, 1)
        )
    )



def job_boards() -> str:
    """Both boards over rows whose key comes from the fields of the rating file."""
    test = board("parts_test", list(PREDICTIONS.items()))
    final = board("parts_validation", [("shrunk item + user + tags + year", FILLED + " + knn")])
    both = f"SELECT 'test' AS rows, * FROM ({test}) UNION ALL SELECT 'validation', * FROM ({final})"
    return both.replace(LINE_KEY, FILE_KEY)


# --- penalties: every candidate refitted

cte("grid", f"SELECT unnest({[float(p) for p in PENALTIES]})::DOUBLE AS penalty")
cte("f_train", f"SELECT {ROW}, rating - mu AS e FROM s_tuning_train, v_mu")
cte("f_test", f"SELECT {ROW}, rating - mu AS e FROM s_tuning_test, v_mu")


def sweep(train: str, test: str, key: str, token: str | None = None) -> str:
    """Error per candidate of the effect by ``key`` on the rows with ``token``."""
    has = f"contains(tags, '{token}')" if token else "true"
    adjust = (
        f"CASE WHEN contains(x.tags, '{token}') THEN coalesce(b, 0.0::DOUBLE) ELSE 0.0::DOUBLE END"
        if token
        else "b"
    )
    return f"""SELECT g.penalty, sqrt(avg((x.e - {adjust}) * (x.e - {adjust}))) AS rmse
FROM {test} x CROSS JOIN grid g LEFT JOIN (
  SELECT {key}, penalty, sum(e) / (count(*) + penalty) AS b FROM {train}, grid WHERE {has}
  GROUP BY {key}, penalty) f ON x.{key} = f.{key} AND g.penalty = f.penalty
GROUP BY g.penalty"""


def subtract(rows: str, train: str, key: str, penalty: str) -> str:
    return f"""SELECT x.* EXCLUDE (e), x.e - f.b AS e FROM {rows} x LEFT JOIN (
  SELECT {key}, sum(e) / (count(*) + {penalty}) AS b FROM {train} GROUP BY {key}) f USING ({key})"""


def add_fixed_chain() -> tuple[str, str]:
    """Train and test residuals before the swept tag stage, with the published penalties."""
    spec = VIEW_SHRUNK
    for side in ("train", "test"):
        cte(f"g_{side}", subtract(f"f_{side}", "f_train", "item_id", double(spec.item_penalty)))
        cte(f"h_{side}", subtract(f"g_{side}", "g_train", "user_id", double(spec.user_penalty)))
    done = [(s, double(s.penalty)) for s in spec.stages[:SWEPT_STAGE]]
    train = add_tag_stages("w", "h_train", done, "")
    test = "h_test"
    for i, (stage, _) in enumerate(done):
        test = cte(f"w_test_{i}", subtract_tag(test, f"w_tag_{i}", stage))
    return train, test


SWEEP_TRAIN, SWEEP_TEST = add_fixed_chain()


def tuned() -> str:
    """All penalties chosen in turn."""

    def best(name: str, errors: str) -> str:
        cte(name, f"SELECT penalty FROM ({errors}) ORDER BY rmse, penalty LIMIT 1")
        return f"(SELECT penalty FROM {name})"

    train, test = "f_train", "f_test"
    chosen = []
    for effect, key in (("item", "item_id"), ("user", "user_id")):
        penalty = best(f"c_{effect}", sweep(train, test, key))
        chosen.append((effect, f"c_{effect}"))
        new_train = cte(f"c_{effect}_train", subtract(train, train, key, penalty))
        test = cte(f"c_{effect}_test", subtract(test, train, key, penalty))
        train = new_train
    for i, stage in enumerate(VIEW_SHRUNK.stages):
        penalty = best(f"c_best_{i}", sweep(train, test, "user_id", stage.token))
        chosen.append((stage.name, f"c_best_{i}"))
        cte(
            f"c_tag_{i}",
            f"""SELECT user_id, sum(e) / (count(*) + {penalty}) AS b FROM {train}
WHERE contains(tags, '{stage.token}') GROUP BY user_id""",
        )
        new_train = cte(f"c_train_{i}", subtract_tag(train, f"c_tag_{i}", stage))
        test = cte(f"c_test_{i}", subtract_tag(test, f"c_tag_{i}", stage))
        train = new_train
    return build(
        " UNION ALL ".join(
            f"SELECT {place} AS place, '{effect}' AS effect, penalty FROM {name}"
            for place, (effect, name) in enumerate(chosen)
        )
    )


# --- exploration


def histogram(rows: str, value: str, centred: bool) -> str:
    width = "(hi - lo) / 29" if centred else "(hi - lo) / 30"
    start = f"lo - {width} / 2" if centred else "lo"
    return build(
        f"""SELECT CAST(bin AS INTEGER) AS bin, {shown('start + (bin - 1) * width', 'low')},
  {shown('start + bin * width', 'high')}, count({value}) AS n
FROM (SELECT min({value}) AS lo, max({value}) AS hi, {width} AS width, {start} AS start FROM {rows})
CROSS JOIN range(1, 31) t(bin)
LEFT JOIN {rows} ON greatest(1, least(30, floor(({value} - start) / width) + 1)) = bin
GROUP BY bin, start, width"""
    )


cte(
    "drawn",
    f"""SELECT user_id FROM (
  SELECT user_id, row_number() OVER (ORDER BY md5(concat_ws('|', 'profile', user_id)), user_id) - 1 AS place
  FROM plain_user)
WHERE place IN (SELECT ('0x' || substr(md5(concat_ws('|', 'profile', j)), 1, 15))::BIGINT
    % (SELECT count(*) FROM plain_user) FROM range(1, {SAMPLED_USERS + 1}) t(j))""",
)
cte(
    "paneled",
    f"""SELECT CAST(panel AS INTEGER) AS panel, user_id FROM (
  SELECT panel, user_id, row_number() OVER (PARTITION BY panel
    ORDER BY md5(concat_ws('|', 'panel|' || panel, user_id))) AS r
  FROM plain_user, range(1, {PANELS + 1}) t(panel)) WHERE r <= {PANEL_SIZE}""",
)
cte(
    "tokens",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{s.name}', '{s.token}')" for s in VIEW_PLAIN.stages)
    + ") v(tag, token)",
)


def profile(sample: str, by: str) -> str:
    return f"""SELECT {by}, tag, avg(rating) FILTER (contains(tags, token)) - any_value(mu)
    - any_value(b_u) - avg(b_i) AS x
FROM {sample} JOIN s_inner_train USING (user_id) JOIN plain_item USING (item_id)
JOIN plain_user USING (user_id) CROSS JOIN tokens CROSS JOIN v_mu
GROUP BY {by}, tag HAVING count(*) FILTER (contains(tags, token)) > 0"""


cte("profiled", profile("drawn", "user_id"))
cte("panel_profiled", profile("paneled", "panel, user_id"))
cte(
    "fenced",
    """SELECT *, q1 - (q3 - q1) * 1.5::DOUBLE AS lo, q3 + (q3 - q1) * 1.5::DOUBLE AS hi FROM (
  SELECT tag, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
  FROM profiled GROUP BY tag)""",
)
cte("first_tokens", "SELECT DISTINCT nullif(regexp_extract(tags, '[a-zA-Z]+', 0), '') AS tag FROM s_outer_train")
MONTHS = """(year(date) - year(first)) * 12 + month(date) - month(first)
  - CASE WHEN day(date) < day(first) THEN 1 ELSE 0 END"""
cte(
    "fitted_dates",
    "SELECT f.residual, r.year, r.date FROM shrunk_fitted f JOIN v_rows_year r USING (rating_key)",
)


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {
        "ratings_view": build(f"SELECT {ROW} FROM v_rows"),
        "ingest_ratings_delimited": build("SELECT user_id, item_id, rating, ts FROM v_rows"),
        "ingest_items_delimited": build("SELECT item_id, title, tags FROM v_items"),
        "ingest_joined": build("SELECT user_id, item_id, rating, ts, title, tags FROM v_rows"),
        "roundtrip_parquet": build(f"SELECT {NARROW}, fold FROM s_outer"),
        "peek_rows": build(f"SELECT {ROW} FROM s_outer_train ORDER BY rating_key LIMIT 6"),
        "fold_counts": build(
            " UNION ALL ".join(
                f"SELECT '{s}' AS split, fold, count(*) AS n FROM s_{s} GROUP BY fold"
                for s in ("outer", "inner", "tuning")
            )
        ),
        "strata_edges": build(
            """SELECT CAST(row_number() OVER (ORDER BY edge) - 1 AS INTEGER) AS place, edge, n AS rows
FROM (SELECT DISTINCT unnest([q0, q1, q2, q3, q4]) AS edge, n FROM s_outer_edges)"""
        ),
        "strata_assignment": build("SELECT rating_key, stratum, held_out FROM s_outer_marked"),
        "split_outer": build("SELECT rating_key, fold FROM s_outer"),
        "split_inner": build("SELECT rating_key, fold FROM s_inner"),
        "split_tuning": build("SELECT rating_key, fold FROM s_tuning"),
        "split_bernoulli": build(
            """SELECT rating_key, ('0x' || substr(md5(concat_ws('|', 'chance', rating_key)), 1, 13))::BIGINT
  < CAST(floor(0.1::DOUBLE * 4503599627370496) AS BIGINT) AS held_out FROM v_rows"""
        ),
        "semi_known_items_users": build(
            f"""SELECT {NARROW} FROM s_inner WHERE fold <> '{TRAIN}'
  AND item_id IN (SELECT item_id FROM s_inner_train) AND user_id IN (SELECT user_id FROM s_inner_train)"""
        ),
        "anti_rejected_rows": build(
            f"""SELECT {NARROW} FROM s_inner WHERE fold <> '{TRAIN}'
EXCEPT ALL SELECT {NARROW} FROM s_inner_test"""
        ),
        "natural_anti_join": build(
            f"SELECT {NARROW} FROM s_outer_train EXCEPT ALL SELECT {NARROW} FROM s_inner_train"
        ),
        "global_mean": build(f"SELECT {shown('mu', 'mu')} FROM v_mu"),
        "global_mean_unknown": build(f"SELECT {shown('mu', 'mu')} FROM u_mu"),
        "item_effect_unknown": build(f"SELECT item_id, {shown('b_i', 'b_i')}, n FROM u_shrunk_item"),
        "user_effect_unknown": build(f"SELECT user_id, {shown('b_u', 'b_u')} FROM u_shrunk_user"),
        "tag_effects_unknown": build(f"SELECT user_id, tag, {shown('b', 'b')}, n FROM u_shrunk_tags"),
        "leaderboard_unknown": build(
            f"""SELECT 1 AS place, 'shrunk item + user + tags' AS method, {shown('rmse', 'rmse')},
  {shown('round(rmse, 4)', 'rmse_4')}, {shown('rmse', 'rmse_scored')}, scored, 0::BIGINT AS missing
FROM (SELECT sqrt(avg(e * e)) AS rmse, count(*) AS scored FROM u_shrunk_left)"""
        ),
        "unreadable_ratings": build(
            f"""SELECT user_id || '::' || item_id || '::::' || ts AS value FROM v_rows
WHERE (user_id + item_id) % {UNKNOWN_EVERY} = 0"""
        ),
        "parsed_lines": build(
            """SELECT CASE way WHEN 0 THEN u || '::' || i || '::::' || t WHEN 1 THEN u || '::' || i || '::4::' || t || '::extra'
    WHEN 2 THEN u || '::' || i || '::NaN::' || t WHEN 3 THEN 'x::' || i || '::4::' || t
    WHEN 4 THEN u || '::' || i || '::4::soon' WHEN 5 THEN '' END AS value,
  CASE way WHEN 0 THEN 'rating' WHEN 1 THEN 'fields' WHEN 2 THEN 'rating' WHEN 3 THEN 'user_id' WHEN 4 THEN 'ts'
    WHEN 5 THEN 'blank' END AS reason,
  CASE way WHEN 6 THEN u END AS user_id, CASE way WHEN 6 THEN i END AS item_id,
  CASE way WHEN 6 THEN r END AS rating, CASE way WHEN 6 THEN t END AS ts
FROM (SELECT (user_id + item_id) % 7 AS way, user_id AS u, item_id AS i, rating AS r, ts AS t FROM v_rows)"""
        ),
        "semi_thin": build(f"SELECT {NARROW} FROM s_inner_test WHERE {THIN_KNOWN}"),
        "anti_thin": build(f"SELECT {NARROW} FROM s_inner_test WHERE NOT ({THIN_KNOWN})"),
        "judged_thin": build(
            f"""SELECT rating_key, CASE WHEN {THIN_KNOWN} THEN '{TEST}' ELSE '{REJECTED}' END AS fold,
  CASE WHEN {THIN_KNOWN} THEN '{TEST}' ELSE '{TRAIN}' END AS returned FROM s_inner_test"""
        ),
        "score_thin": build(
            f"SELECT rating_key, {shown('mu + si + su + st', 'pred')}, {shown(FILLED, 'filled')} FROM t_parts"
        ),
        "leaderboard_thin": board(
            "t_parts",
            [("shrunk item + user + tags", "mu + si + su + st"), ("shrunk item + user + tags", FILLED)],
        ),
        "tag_effect_map": build(
            f"""SELECT user_id, count(*) AS tags, string_agg(tag, ',' ORDER BY tag) AS names,
  {shown('sum(b)', 'total')} FROM shrunk_tags GROUP BY user_id
UNION ALL SELECT user_id, 0, '', 0.0::DOUBLE FROM shrunk_user
WHERE user_id NOT IN (SELECT user_id FROM shrunk_tags)"""
        ),
        "fitted_table": build(
            f"SELECT rating_key, {shown('pred', 'pred')}, {shown('residual', 'residual')} FROM shrunk_fitted"
        ),
        "score_full_validation": scored("parts_validation", FILLED + " + knn"),
        "rmse_propagate": build(
            f"SELECT {shown(whole_rmse('mu + si + su + st + knn'), 'rmse')} FROM parts_test"
        ),
        "rmse_skip": build(f"SELECT {shown(rmse('mu + si + su + st + knn'), 'rmse')} FROM parts_test"),
        "leaderboard": board("parts_test", list(PREDICTIONS.items())),
        "final_holdout": board(
            "parts_validation",
            [
                ("shrunk item + user + tags + year", FILLED + " + knn"),
                ("shrunk item + user + tags + year", FILLED + " + coalesce(knn, 0.0::DOUBLE)"),
            ],
        ),
        "job_from_files": job_boards(),
        "sweep_item": build(
            f"SELECT penalty, {shown('rmse', 'rmse')} FROM ({sweep('f_train', 'f_test', 'item_id')})"
        ),
        "best_lambda": build(
            f"""SELECT penalty, {shown('rmse', 'rmse')} FROM ({sweep('f_train', 'f_test', 'item_id')}) s
ORDER BY s.rmse, penalty LIMIT 1"""
        ),
        "sweep_user": build(
            f"SELECT penalty, {shown('rmse', 'rmse')} FROM ({sweep('g_train', 'g_test', 'user_id')})"
        ),
        "sweep_tag": build(
            f"""SELECT penalty, {shown('rmse', 'rmse')} FROM (
{sweep(SWEEP_TRAIN, SWEEP_TEST, 'user_id', VIEW_SHRUNK.stages[SWEPT_STAGE].token)})"""
        ),
        "tuned_penalties": tuned(),
        "release_year": build(
            r"""SELECT item_id,
  TRY_CAST(nullif(regexp_extract(title, '(\d{4})\)$', 1), '') AS INTEGER) AS year,
  nullif(regexp_extract(tags, '[a-zA-Z]+', 0), '') AS first_token FROM v_items"""
        ),
        "rating_dates": build(
            f"""SELECT rating_key, CAST(date AS VARCHAR) AS date, CAST(date_diff('day', first, date) // 7 AS INTEGER) AS weeks,
  CAST({MONTHS} AS INTEGER) AS months, CAST(year(date) - year AS INTEGER) AS age
FROM v_rows_year, (SELECT min(date) AS first FROM v_rows_year)"""
        ),
        "year_residual": build(f"SELECT year, {shown('b', 'b')}, n FROM years"),
        "k_errors": build(f"SELECT k, {shown('rmse', 'rmse')} FROM k_tried"),
        "choose_k": build(f"SELECT k, {shown('rmse', 'rmse')} FROM k_best"),
        "natural_left_join": build(
            f"""SELECT x.year, rating_key, y.n, {shown('y.knn', 'knn')}
FROM s_inner_test JOIN v_rows_year x USING (rating_key)
LEFT JOIN year_smooth y ON x.year IS NOT DISTINCT FROM y.year"""
        ),
        "tag_frequency_first_token": build(
            """SELECT t.tag, count(*) AS n FROM first_tokens t JOIN s_outer_train x ON contains(x.tags, t.tag)
GROUP BY t.tag"""
        ),
        "tag_frequency_all": build(
            """SELECT tag, count(*) AS n FROM (
  SELECT unnest(list_distinct(string_split(tags, '|'))) AS tag FROM s_outer_train) GROUP BY tag"""
        ),
        "sampled_users": build("SELECT user_id FROM drawn"),
        "panel_users": build("SELECT panel, user_id FROM paneled"),
        "user_tag_profile": build(f"SELECT user_id, tag, {shown('x', 'x')} FROM profiled"),
        "tag_box_stats": build(
            f"""SELECT *, CAST(rank() OVER (ORDER BY round(m, 9)) AS INTEGER) AS place FROM (
  SELECT p.tag, {shown('q1', 'q1')}, {shown('median', 'median')}, median AS m, {shown('q3', 'q3')},
    {shown('min(x) FILTER (round(x, 9) BETWEEN round(lo, 9) AND round(hi, 9))', 'whisker_low')},
    {shown('max(x) FILTER (round(x, 9) BETWEEN round(lo, 9) AND round(hi, 9))', 'whisker_high')}, count(*) AS n,
    count(*) FILTER (round(x, 9) NOT BETWEEN round(lo, 9) AND round(hi, 9)) AS outliers
  FROM profiled p JOIN fenced f ON p.tag = f.tag GROUP BY p.tag, f.q1, f.median, f.q3)"""
        ).replace("SELECT *, CAST(rank()", "SELECT * EXCLUDE (m), CAST(rank()"),
        "tag_box_outliers": build(
            f"""SELECT user_id, p.tag, {shown('x', 'x')} FROM profiled p JOIN fenced f ON p.tag = f.tag
WHERE round(x, 9) NOT BETWEEN round(lo, 9) AND round(hi, 9)"""
        ),
        "panel_profiles": build(
            f"""SELECT p.panel, p.user_id, p.tag, {shown('x', 'x')}, place FROM panel_profiled p JOIN (
  SELECT panel, tag, CAST(rank() OVER (PARTITION BY panel ORDER BY round(median, 9)) AS INTEGER) AS place FROM (
    SELECT panel, tag, quantile_cont(x, 0.5) AS median FROM panel_profiled GROUP BY panel, tag)) m
USING (panel, tag)"""
        ),
        "residual_by_month": build(
            f"""SELECT CAST({MONTHS} AS INTEGER) AS month, {shown('avg(residual)', 'b')}
FROM fitted_dates, (SELECT min(date) AS first FROM fitted_dates) GROUP BY 1"""
        ),
        "residual_by_age": build(
            f"""SELECT CAST(year(date) - year AS INTEGER) AS age, {shown('avg(residual)', 'b')}
FROM fitted_dates WHERE year(date) - year >= 0 GROUP BY 1"""
        ),
        "residual_by_release_year": build(
            f"SELECT year, {shown('avg(residual)', 'b')}, count(*) AS n FROM fitted_dates GROUP BY year"
        ),
        "curve_long": build(
            f"""SELECT year, 'mean' AS key, {shown('b', 'value')} FROM year_smooth
UNION ALL SELECT year, 'knn', {shown('knn', 'value')} FROM year_smooth"""
        ),
    }
    for spec in ("plain", "shrunk"):
        out[f"item_effect_{spec}"] = build(f"SELECT item_id, {shown('b_i', 'b_i')}, n FROM {spec}_item")
        out[f"user_effect_{spec}"] = build(f"SELECT user_id, {shown('b_u', 'b_u')}, n FROM {spec}_user")
        out[f"tag_effects_{spec}"] = build(f"SELECT user_id, tag, {shown('b', 'b')}, n FROM {spec}_tags")
    out["staged_fit"] = out["tag_effects_shrunk"]
    names = ("average", "item", "item_user", "tags_plain", "tags_shrunk", "full_test")
    for name, prediction in zip(names, PREDICTIONS.values()):
        out[f"score_{name}"] = scored("parts_test", prediction)
    for name, k, with_n in (
        ("knn_smooth", str(SMALL_K), True),
        ("knn_smooth_year_only", str(SMALL_K), False),
        ("year_effect", "(SELECT k FROM k_best)", True),
    ):
        out[name] = build(f"SELECT year, {shown('b', 'b')}, n, {shown('knn', 'knn')} FROM ({smoothed(k, with_n)})")
    for effect, table, value in (("item", "plain_item", "b_i"), ("user", "plain_user", "b_u")):
        out[f"hist_{effect}_effect"] = histogram(table, value, False)
        out[f"hist_{effect}_effect_centred"] = histogram(table, value, True)
    return out
