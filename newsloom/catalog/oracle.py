"""DuckDB SQL for the queries. Named building blocks are put in front of a query as it needs them."""

from __future__ import annotations

import re

from newsloom.operators.beyond import POISSON_1

WORD = r"[\p{L}\p{N}_]+"

# Building blocks, each using only tables and blocks above it.
PARTS: dict[str, str] = {
    "c_step": "SELECT count(*) // 100 AS step FROM embeddings",
    "c_ev": """SELECT event_id, user_id, ts, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, step
        FROM events, c_step""",
    "c_cand0": """SELECT event_id, user_id, ts, j, k,
        CAST(((k + 1000 + (j - event_id % 10) * (7 + 10 * (event_id % 9))) % 100 + 1) * step + user_id % step AS BIGINT) AS aid,
        CASE WHEN event_type IN ('click', 'purchase') AND j = event_id % 10 THEN 1 ELSE 0 END AS label
        FROM c_ev, range(10) r(j)""",
    "c_hist0": """SELECT event_id, user_id, ts, k, CAST(i AS BIGINT) AS pos,
        CAST(((k + 3 + i * (event_id % 5)) % 100 + 1) * step + user_id % step AS BIGINT) AS aid
        FROM c_ev, range(15) r(i) WHERE i < k % 16""",
    "c_histlist": """SELECT event_id, user_id, ts, string_agg(aid, ' ' ORDER BY pos) AS history, list(aid ORDER BY pos) AS items
        FROM c_hist0 GROUP BY ALL""",
    "c_first": """SELECT DISTINCT ON (user_id) user_id, event_id FROM c_ev ORDER BY user_id, ts, event_id""",
    "c_hist": """SELECT CAST(h.user_id AS VARCHAR) AS user_id, pos, CAST(aid AS VARCHAR) AS article_id
        FROM c_hist0 h JOIN c_first USING (event_id)""",
    "c_users": """SELECT CAST(f.user_id AS VARCHAR) AS user_id, coalesce(h.history, '') AS history,
        coalesce(len(h.items), 0) AS hist_len FROM c_first f LEFT JOIN c_histlist h USING (event_id)""",
    "c_max": "SELECT max(ts) AS mx FROM c_ev",
    "c_split": """SELECT event_id, CASE WHEN ts > mx - INTERVAL 1 DAY THEN 'test' WHEN ts > mx - INTERVAL 2 DAY THEN 'val'
        ELSE 'train' END AS split FROM c_ev, c_max""",
    "c_imp": """SELECT CAST(event_id AS VARCHAR) AS impression_id, event_id, CAST(user_id AS VARCHAR) AS user_id, ts AS time,
        coalesce(string_agg(aid, ' ' ORDER BY j) FILTER (label = 1), '') AS clicked,
        string_agg(aid, ' ' ORDER BY j) FILTER (label = 0) AS unclicked, string_agg(aid, ' ' ORDER BY j) AS inview,
        sum(label) AS n_clicked, k, string_agg(aid || '-' || label, ' ' ORDER BY j) AS impressions
        FROM c_cand0 GROUP BY event_id, user_id, ts, k""",
    "c_cands": """SELECT CAST(event_id AS VARCHAR) AS row_id, CAST(user_id AS VARCHAR) AS user_id, event_id, j,
        row_number() OVER (PARTITION BY event_id ORDER BY label DESC, j) - 1 AS pos, CAST(aid AS VARCHAR) AS article_id, label
        FROM c_cand0""",
    "c_test": "SELECT c.* FROM c_cands c JOIN c_split s USING (event_id) WHERE split = 'test'",
    "c_art": """SELECT CAST(doc_id AS VARCHAR) AS article_id, split_part(text, chr(10), 1) AS title,
        CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
        '' AS body, lang AS category FROM documents""",
    "c_news": """SELECT CAST(doc_id AS VARCHAR) AS article_id, lang AS category, source AS subcategory,
        regexp_replace(text, '[\\t\\r\\n]', ' ', 'g') AS title, CASE WHEN n_chars % 2 = 0 THEN source END AS abstract,
        'http://news.example/' || doc_id AS url,
        '[{"Label":"' || source || '","Type":"S","WikidataId":"Q' || length(source) ||
        '","Confidence":0.5,"OccurrenceOffsets":[0],"SurfaceForms":["' || source ||
        '"]},{"Label":"l","Type":"L","WikidataId":"Q' || doc_id % 7 || '","Confidence":1.0}]' AS title_entities,
        source, doc_id FROM documents""",
    "c_toklist": f"SELECT article_id, regexp_extract_all(lower(title || ' ' || abstract), '{WORD}') AS tokens FROM c_art",
    "c_dl": "SELECT article_id, CAST(len(tokens) AS BIGINT) AS dl FROM c_toklist",
    "c_tf": """SELECT article_id, term, count(*) AS tf FROM (SELECT article_id, unnest(tokens) AS term FROM c_toklist)
        GROUP BY ALL""",
    "c_stats": "SELECT count(*) AS n, sum(dl) / count(*) AS avgdl FROM c_dl",
    "c_df": "SELECT term, count(*) AS df FROM c_tf GROUP BY term",
    "c_post": """SELECT term, article_id, tf, dl, df, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf,
        ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) AS weight
        FROM c_tf JOIN c_df USING (term) JOIN c_dl USING (article_id), c_stats""",
    "c_query": "SELECT DISTINCT user_id, term FROM c_hist JOIN c_tf USING (article_id)",
    "c_pairs": "SELECT DISTINCT user_id, article_id FROM c_test",
    "c_match": """SELECT user_id, p.article_id, term, tf, weight FROM c_pairs p JOIN c_post USING (article_id)
        JOIN c_query USING (user_id, term)""",
    "c_lex": """SELECT user_id, article_id, round(coalesce(s, 0), 9) AS lexical FROM c_pairs
        LEFT JOIN (SELECT user_id, article_id, sum(weight) AS s FROM c_match GROUP BY ALL) USING (user_id, article_id)""",
    "c_dims": """SELECT CAST(vec_id AS VARCHAR) AS article_id, CAST(unnest(embedding) AS DOUBLE) AS raw,
        generate_subscripts(embedding, 1) - 1 AS dim, label AS grp FROM embeddings""",
    "c_norm": "SELECT article_id, sqrt(sum(raw * raw)) AS norm FROM c_dims GROUP BY article_id",
    "c_unit": """SELECT article_id, dim, CASE WHEN norm > 0 THEN raw / norm ELSE 0 END AS x
        FROM c_dims JOIN c_norm USING (article_id)""",
    "c_mean": "SELECT user_id, dim, avg(x) AS m FROM c_hist JOIN c_unit USING (article_id) GROUP BY ALL",
    "c_uvec": """SELECT user_id, dim, CASE WHEN l > 0 THEN m / l ELSE 0 END AS x FROM c_mean
        JOIN (SELECT user_id, sqrt(sum(m * m)) AS l FROM c_mean GROUP BY user_id) USING (user_id)""",
    "c_known": "SELECT DISTINCT user_id FROM c_uvec",
    "c_dot": """SELECT user_id, article_id, sum(u.x * v.x) AS s FROM c_pairs JOIN c_uvec u USING (user_id)
        JOIN c_unit v USING (article_id, dim) GROUP BY ALL""",
    # Score by pair; null without an article vector, 0 without a user vector.
    "c_sem": """SELECT user_id, article_id, CASE WHEN v.article_id IS NULL THEN NULL
        WHEN k.user_id IS NULL THEN 0.0 ELSE round(s, 9) END AS semantic
        FROM c_pairs p LEFT JOIN c_norm v USING (article_id) LEFT JOIN c_known k USING (user_id)
        LEFT JOIN c_dot USING (user_id, article_id)""",
    "c_semrank": """SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY semantic DESC, pos) AS rank
        FROM c_test JOIN c_sem USING (user_id, article_id) WHERE semantic IS NOT NULL""",
    "c_lexrank": """SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY lexical DESC, pos) AS rank
        FROM c_test JOIN c_lex USING (user_id, article_id)""",
    "c_pop": """SELECT CAST(aid AS VARCHAR) AS article_id, count(*) AS clicks FROM c_cand0 JOIN c_split USING (event_id)
        WHERE label = 1 AND split = 'train' GROUP BY ALL""",
    "c_popall": "SELECT CAST(aid AS VARCHAR) AS article_id, count(*) AS clicks FROM c_cand0 WHERE label = 1 GROUP BY ALL",
    "c_popscore": """SELECT t.*, coalesce(clicks, 0) AS score FROM c_test t LEFT JOIN c_pop USING (article_id)
        WHERE row_id IN (SELECT row_id FROM c_test GROUP BY row_id HAVING sum(label) > 0 AND sum(label) < count(*))""",
    # Both models side by side over comparable impressions.
    "c_both": """SELECT t.*, lexical, semantic, hist_len, coalesce(category, 'unknown') AS category
        FROM c_test t JOIN c_lex USING (user_id, article_id) JOIN c_sem USING (user_id, article_id)
        JOIN c_users u USING (user_id) LEFT JOIN c_art a USING (article_id)
        WHERE hist_len > 0 AND row_id IN (SELECT row_id FROM c_test JOIN c_sem USING (user_id, article_id)
            GROUP BY row_id HAVING sum(label) > 0 AND sum(label) < count(*) AND count(semantic) = count(*))""",
    "c_models": """SELECT 'lexical' AS model, row_id, hist_len, pos, label, category, lexical AS score FROM c_both
        UNION ALL SELECT 'semantic', row_id, hist_len, pos, label, category, semantic FROM c_both""",
    "c_popmodel": "SELECT 'popularity' AS model, row_id, 0 AS hist_len, pos, label, '' AS category, score FROM c_popscore",
    "c_log": """SELECT event_id AS impression_id, user_id, time AS ts, k, inview, clicked, n_clicked,
        CASE WHEN k % 3 > 0 THEN CAST(k * 7 % 101 AS DOUBLE) END AS scroll_percentage, CAST(k AS DOUBLE) AS read_time,
        CAST(k % 3 AS BIGINT) AS device_type, k % 4 = 0 AS is_sso_user, CASE WHEN k % 5 > 0 THEN k % 2 = 0 END AS is_subscriber,
        CASE WHEN k % 33 = 0 THEN k % 2 END AS gender, CAST(c_imp.user_id AS BIGINT) * 1000 + k % 7 AS session_id,
        CAST(nullif(clicked, '') AS BIGINT) AS article_id FROM c_imp, (SELECT 1)""",
    "c_readers": "SELECT DISTINCT user_id FROM c_test",
    "c_vtop": """SELECT user_id, article_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, article_id) AS rank
        FROM (SELECT user_id, article_id, round(sum(u.x * v.x), 9) AS score FROM c_uvec u JOIN c_readers USING (user_id)
        JOIN c_unit v USING (dim) GROUP BY ALL) QUALIFY rank <= 10""",
    "c_ltop": """SELECT user_id, article_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, article_id) AS rank
        FROM (SELECT user_id, article_id, round(sum(weight), 9) AS score FROM c_query JOIN c_readers USING (user_id)
        JOIN c_post USING (term) GROUP BY ALL) QUALIFY rank <= 10""",
    "c_clicks": """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(aid AS VARCHAR) AS article_id, event_id,
        ts + INTERVAL 1 HOUR * (3 - (pos + 1) * 2) AS click_time FROM c_hist0""",
    "c_age": """SELECT user_id, article_id, epoch_us(TIMESTAMP '2024-01-31') / 1e6 - epoch_us(click_time) / 1e6 AS age
        FROM c_clicks WHERE click_time <= TIMESTAMP '2024-01-31'""",
    "c_late": """SELECT CAST(user_id AS VARCHAR) AS user_id, arg_max(coalesce(history, ''), event_id) AS history
        FROM (SELECT e.user_id, e.event_id, h.history FROM c_ev e JOIN c_split s USING (event_id)
        LEFT JOIN c_histlist h USING (event_id) WHERE split = 'test') GROUP BY ALL""",
}
# Retrieved lists of depth 200 and the recall of test clicks in them, per user and per user and band.
_DEEP = {
    "c_vtop": PARTS["c_vtop"].replace("rank <= 10", "rank <= 200"),
    "c_ltop": PARTS["c_ltop"].replace("rank <= 10", "rank <= 200"),
    "c_levels": "SELECT clicks, (SELECT count(*) FROM c_pop p WHERE p.clicks > l.clicks) AS above FROM (SELECT DISTINCT clicks FROM c_pop) l",
    "c_band": """SELECT article_id, clicks, CASE WHEN clicks >= (SELECT min(clicks) FROM c_levels
        WHERE above <= (1 - 0.8::DOUBLE) * (SELECT count(*) FROM c_pop)) THEN 'head' ELSE 'tail' END AS band FROM c_pop""",
    "c_clicked": """SELECT DISTINCT t.user_id, t.article_id, coalesce(u.hist_len, 0) AS hist_len, coalesce(b.band, 'tail') AS band
        FROM c_test t LEFT JOIN c_users u ON u.user_id = t.user_id LEFT JOIN c_band b ON b.article_id = t.article_id WHERE label = 1""",
    "c_tops": "SELECT 'lexical' AS model, user_id, article_id, rank FROM c_ltop UNION ALL SELECT 'semantic', user_id, article_id, rank FROM c_vtop",
    "c_found": """SELECT m.model, c.user_id, c.hist_len, c.band, r.rank FROM c_clicked c CROSS JOIN (SELECT 'lexical' AS model UNION ALL SELECT 'semantic') m
        LEFT JOIN c_tops r ON r.model = m.model AND r.user_id = c.user_id AND r.article_id = c.article_id""",
    "c_deep": "SELECT model, user_id, hist_len, " + ", ".join(f"count(*) FILTER (rank <= {k}) / count(*) AS recall_{k}" for k in (50, 100, 200)) + " FROM c_found GROUP BY ALL",
    "c_deepband": "SELECT model, user_id, band, " + ", ".join(f"count(*) FILTER (rank <= {k}) / count(*) AS recall_{k}" for k in (50, 100, 200)) + " FROM c_found GROUP BY ALL",
    "c_bandlong": "UNPIVOT c_deepband ON recall_50, recall_100, recall_200 INTO NAME metric VALUE value",
}
# For queries over all impressions instead of the test day.
ALL = {"c_test": "SELECT c.* FROM c_cands c"}
# Blocks that are worth computing once where several others read them.
_ONCE = {"c_ev", "c_cand0", "c_cands", "c_pop", "c_tf", "c_post", "c_unit", "c_pairs", "c_lex", "c_sem"}
_NAME = re.compile(r"\bc_[a-z0-9]+\b")


def with_parts(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` behind the building blocks it names, directly or through other blocks."""
    parts = PARTS | (extra or {})
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in parts and name not in order:
                visit(parts[name])
                if name not in order:
                    order.append(name)

    visit(body)
    ctes = ", ".join(f"{n} AS {'MATERIALIZED ' if n in _ONCE else ''}({parts[n]})" for n in order)
    if body.lstrip().startswith("WITH "):
        return f"WITH {ctes}, {body.lstrip()[5:]}" if ctes else body
    return f"WITH {ctes} {body}" if ctes else body


def metric_parts(source: str) -> dict[str, str]:
    """Blocks for per-impression metrics of (model, row_id, hist_len, pos, label, category, score) rows."""
    same = "OVER (PARTITION BY model, row_id, score)"
    return {
        "c_ranked": f"""SELECT *, row_number() OVER (PARTITION BY model, row_id ORDER BY score DESC, pos) AS rn,
            count(*) OVER (PARTITION BY model, row_id) AS n, sum(label) OVER (PARTITION BY model, row_id) AS p FROM {source}""",
        "c_disc": """SELECT *, CASE WHEN rn <= 5 THEN 1 / log2(rn + 1) ELSE 0 END AS d5,
            CASE WHEN rn <= 10 THEN 1 / log2(rn + 1) ELSE 0 END AS d10 FROM c_ranked""",
        "c_tied": f"SELECT *, avg(d5) {same} AS t5, avg(d10) {same} AS t10, avg(n - rn + 1) {same} AS up FROM c_disc",
        "c_metrics": """SELECT model, row_id, hist_len,
            CASE WHEN max(p) > 0 AND max(n) > max(p) THEN (sum(up * label) - max(p) * (max(p) + 1) / 2) / (max(p) * (max(n) - max(p))) END AS auc,
            max(CASE WHEN label = 1 THEN 1.0 / rn ELSE 0 END) AS mrr,
            CASE WHEN max(p) > 0 THEN sum(label * t5) / sum(CASE WHEN rn <= p THEN d5 ELSE 0 END) ELSE 0 END AS ndcg_5,
            CASE WHEN max(p) > 0 THEN sum(label * t10) / sum(CASE WHEN rn <= p THEN d10 ELSE 0 END) ELSE 0 END AS ndcg_10,
            count(DISTINCT category) FILTER (rn <= 5) / count(*) FILTER (rn <= 5) AS category_diversity_5
            FROM c_tied GROUP BY model, row_id, hist_len""",
    }


METRICS = ("auc", "mrr", "ndcg_5", "ndcg_10", "category_diversity_5")
_SLICES = " UNION ALL ".join(f"SELECT '{s}' AS slice, {lo} AS lo, {hi} AS hi" for s, lo, hi in
                             (("global", 0, 10**9), ("cold", 0, 4), ("warm", 5, 10**9)))


def _report(source: str, names) -> str:
    """(model, slice, metric, value) means of `source` columns."""
    cols = ", ".join(names)
    return f"""SELECT m.model, s.slice, m.metric, round(coalesce(avg(v.value), 0), 6) AS value
        FROM (SELECT DISTINCT model, metric FROM c_long) m CROSS JOIN ({_SLICES}) s
        LEFT JOIN c_long v ON v.model = m.model AND v.metric = m.metric AND v.hist_len BETWEEN s.lo AND s.hi
        GROUP BY ALL""", {"c_long": f"UNPIVOT {source} ON {cols} INTO NAME metric VALUE value"}


def _slices(source: str, names, extra: dict[str, str], more: str = "") -> str:
    body, long = _report(source, names)
    return with_parts(body + more, extra | long)


def _metrics_sql(body: str, source: str = "c_models") -> str:
    return with_parts(body, metric_parts(source))


def _metric(name: str) -> str:
    return with_parts(f"SELECT row_id, {name} FROM c_metrics", metric_parts("c_popmodel") | ALL)


def _recall(source: str, score: str, unknown: str = "") -> dict[str, str]:
    """Recall block over clicked test impressions; unranked candidates still count as clicked."""
    rank = f"CASE WHEN {score} IS NOT NULL THEN row_number() OVER (PARTITION BY row_id ORDER BY {score} DESC NULLS LAST, pos) END"
    sums = ", ".join(f"sum(CASE WHEN rank <= {k} THEN label ELSE 0 END) / sum(label) AS recall_{k}" for k in (1, 3, 5))
    return {
        f"c_r{score}": f"SELECT *, {rank} AS rank FROM c_test JOIN {source} USING (user_id, article_id)",
        f"c_rec{score}": f"""SELECT row_id, any_value(user_id) AS user_id, {sums} FROM c_r{score} GROUP BY row_id
            HAVING sum(label) > 0 AND count({score}) > 0""",
    }


LEX_RECALL, SEM_RECALL = _recall("c_lex", "lexical"), _recall("c_sem", "semantic")
R135 = "round(recall_1, 6) AS recall_1, round(recall_3, 6) AS recall_3, round(recall_5, 6) AS recall_5"
STAMP = "'%Y-%m-%d %H:%M:%S'"
BEHAVIOR_TIME = """CASE WHEN k = 50 THEN 'n/a' WHEN k % 2 = 0 THEN strftime(time, '%-m/%-d/%Y %-I:%M:%S %p')
    ELSE strftime(time, '%-m/%-d/%Y %-H:%M:%S') END"""
POP_LINES = """SELECT event_id AS row_id, event_id || ' [' || string_agg(rank, ',' ORDER BY j) || ']' AS value FROM (
    SELECT event_id, j, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(clicks, 0) DESC, j) AS rank
    FROM c_test LEFT JOIN c_pop USING (article_id)) GROUP BY event_id"""


def _semantic_lines(known: str, dot: str) -> str:
    """Prediction lines from a dot-product block; -999 where the article has no vector and the reader has one."""
    return f"""SELECT event_id AS row_id, event_id || ' [' || string_agg(rank, ',' ORDER BY j) || ']' AS value FROM (
        SELECT event_id, j, row_number() OVER (PARTITION BY event_id ORDER BY CASE WHEN k.reader IS NULL THEN 0
            WHEN v.article_id IS NULL THEN -999 ELSE round(s, 9) END DESC, j) AS rank
        FROM (SELECT *, {known} AS reader FROM c_test) t LEFT JOIN c_norm v USING (article_id)
        LEFT JOIN (SELECT DISTINCT reader FROM {dot}0) k USING (reader)
        LEFT JOIN {dot} USING (reader, article_id)) GROUP BY event_id"""


def _summary(pairs: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count({e}) AS n, round(min({e}), 6)::DOUBLE AS min_value, round(max({e}), 6)::DOUBLE AS max_value,
        round(avg({e}), 6) AS mean_value, round(median(CAST({e} AS DOUBLE)), 6) AS median_value FROM {source}""" for name, e in pairs)


def _nulls(cols: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({e}) AS n_nulls,
        round((count(*) - count({e})) * 100.0 / count(*), 6) AS pct_nulls FROM {source}""" for c, e in cols.items())


LOG_COLUMNS = {"impression_id": "impression_id", "user_id": "user_id", "impression_time": "ts", "article_ids_inview": "inview",
               "article_ids_clicked": "clicked", "article_id": "article_id", "read_time": "read_time",
               "scroll_percentage": "scroll_percentage", "device_type": "device_type", "is_sso_user": "is_sso_user",
               "is_subscriber": "is_subscriber", "gender": "gender", "session_id": "session_id"}
_TEST_ONLY, _TRAIN_ONLY = ("is_beyond_accuracy",), ("article_ids_clicked", "article_id")


def _presence() -> str:
    out = []
    for c, e in (LOG_COLUMNS | {"is_beyond_accuracy": "user_id"}).items():
        train, test = c not in _TEST_ONLY, c not in _TRAIN_ONLY
        out.append(f"""SELECT '{c}' AS column_name, {f'count({e})' if train else 0}::BIGINT AS n_train,
            {f'count({e})' if test else 0}::BIGINT AS n_test, {train} AS in_train, {test} AS in_test FROM c_log""")
    return " UNION ALL ".join(out)


def _poisson(u: str) -> str:
    return " + ".join(f"CAST({u} >= {limit} AS INTEGER)" for limit in POISSON_1)


_P = 2147483647
BOOT_NAMES = ("auc", "mrr", "ndcg_5", "ndcg_10")
BOOT_PARTS = {
    "c_hash": f"SELECT *, CAST('0x' || substr(md5(row_id), 1, 8) AS BIGINT) % {_P} AS h FROM c_metrics",
    "c_x1": f"SELECT *, (h + (rep + 1) * 40503 + 7919) % {_P} AS x1 FROM c_hash, range(200) r(rep)",
    "c_x2": f"SELECT *, (x1 * x1 + 12345) % {_P} AS x2 FROM c_x1",
    "c_x3": f"SELECT *, (x2 * 48271 + rep) % {_P} AS x3 FROM c_x2",
    "c_x4": f"SELECT *, ((x3 * x3 + h) % {_P}) / {_P}.0::DOUBLE AS u FROM c_x3",
    "c_w": f"SELECT *, {_poisson('u')} AS w FROM c_x4",
    "c_reps": "SELECT model, rep, " + ", ".join(f"sum(w * {m}) / sum(w) AS {m}" for m in BOOT_NAMES) + " FROM c_w GROUP BY ALL",
    "c_replong": f"UNPIVOT c_reps ON {', '.join(BOOT_NAMES)} INTO NAME metric VALUE value",
}



def _intervals(source: str, key: str, names: tuple[str, ...], tag: str, b: int = 1000) -> dict[str, str]:
    """Block c_ci<tag>: (model, slice, metric, value, low, high) over rows of `source` (model, hist_len, key, names)."""
    return {
        f"c_sl{tag}": f"""SELECT s.slice, r.* FROM {source} r JOIN ({_SLICES}) s ON r.hist_len BETWEEN s.lo AND s.hi""",
        f"c_h{tag}": f"SELECT *, CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {_P} AS h FROM c_sl{tag}",
        f"c_xa{tag}": f"SELECT *, (h + (rep + 1) * 40503 + 7919) % {_P} AS x1 FROM c_h{tag}, range({b}) r(rep)",
        f"c_xb{tag}": f"SELECT *, (x1 * x1 + 12345) % {_P} AS x2 FROM c_xa{tag}",
        f"c_xc{tag}": f"SELECT *, (x2 * 48271 + rep) % {_P} AS x3 FROM c_xb{tag}",
        f"c_xd{tag}": f"SELECT *, ((x3 * x3 + h) % {_P}) / {_P}.0::DOUBLE AS u FROM c_xc{tag}",
        f"c_w{tag}": f"SELECT *, {_poisson('u')} AS w FROM c_xd{tag}",
        f"c_rp{tag}": "SELECT model, slice, rep, " + ", ".join(f"sum(w * {m}) / sum(w) AS {m}" for m in names) + f" FROM c_w{tag} GROUP BY ALL",
        f"c_rl{tag}": f"UNPIVOT c_rp{tag} ON {', '.join(names)} INTO NAME metric VALUE value",
        f"c_mn{tag}": "SELECT model, slice, " + ", ".join(f"avg({m}) AS {m}" for m in names) + f" FROM c_sl{tag} GROUP BY ALL",
        f"c_ml{tag}": f"UNPIVOT c_mn{tag} ON {', '.join(names)} INTO NAME metric VALUE value",
        f"c_ci{tag}": f"""SELECT m.model, m.slice, m.metric, any_value(m.value) AS value, quantile_cont(r.value, 0.025) AS low, quantile_cont(r.value, 0.975) AS high
            FROM c_ml{tag} m JOIN c_rl{tag} r ON r.model = m.model AND r.slice = m.slice AND r.metric = m.metric GROUP BY ALL""",
    }


_LISTS = {
    "c_both10": """SELECT 'lexical' AS model, user_id, article_id FROM c_ltop UNION ALL SELECT 'semantic', user_id, article_id FROM c_vtop""",
    "c_listed": "SELECT b.*, hist_len FROM c_both10 b JOIN c_users USING (user_id)",
    "c_ild": """SELECT model, user_id, CASE WHEN n > 1 THEN 1 - (sum(s * s) - n) / (n * (n - 1)) ELSE 0 END AS ild FROM (
        SELECT model, user_id, dim, count(*) AS n, sum(x) AS s FROM c_listed JOIN c_unit USING (article_id) GROUP BY ALL) GROUP BY model, user_id, n""",
    "c_nov": """SELECT model, user_id, hist_len, avg(-log2((coalesce(clicks, 0) + 1) / ((SELECT sum(clicks) FROM c_pop) + (SELECT count(*) FROM documents)))) AS novelty
        FROM c_listed LEFT JOIN c_pop USING (article_id) GROUP BY ALL""",
    "c_lists": "SELECT n.model, n.user_id, n.hist_len, coalesce(ild, 0) AS ild, novelty FROM c_nov n LEFT JOIN c_ild i ON i.model = n.model AND i.user_id = n.user_id",
    "c_cov": f"""SELECT model, slice, count(DISTINCT article_id) / (SELECT count(*) FROM documents) AS value FROM c_listed SEMI JOIN c_art USING (article_id)
        JOIN ({_SLICES}) s ON hist_len BETWEEN s.lo AND s.hi GROUP BY ALL""",
}
_SEM_DOTS_USER = {
    "c_sd0": "SELECT user_id AS reader, dim, x FROM c_uvec",
    "c_sd": """SELECT reader, article_id, sum(u.x * v.x) AS s FROM (SELECT DISTINCT user_id AS reader, article_id FROM c_test)
        JOIN c_sd0 u USING (reader) JOIN c_unit v USING (article_id, dim) GROUP BY ALL""",
}
_SEM_DOTS_ROW = {
    "c_rm": """SELECT CAST(event_id AS VARCHAR) AS reader, dim, avg(x) AS m
        FROM (SELECT event_id, CAST(aid AS VARCHAR) AS article_id FROM c_hist0 JOIN c_split USING (event_id) WHERE split = 'test')
        JOIN c_unit USING (article_id) GROUP BY ALL""",
    "c_sd0": """SELECT reader, dim, CASE WHEN l > 0 THEN m / l ELSE 0 END AS x FROM c_rm
        JOIN (SELECT reader, sqrt(sum(m * m)) AS l FROM c_rm GROUP BY reader) USING (reader)""",
    "c_sd": """SELECT reader, article_id, sum(u.x * v.x) AS s FROM (SELECT row_id AS reader, article_id FROM c_test)
        JOIN c_sd0 u USING (reader) JOIN c_unit v USING (article_id, dim) GROUP BY ALL""",
}
_TFIDF = {
    "c_ti": "SELECT term, article_id, tf * ln((n + 1) / (df + 1)) AS raw, ln((n + 1) / (df + 1)) AS ti FROM c_post, c_stats",
    "c_tn": "SELECT article_id, sqrt(sum(raw * raw)) AS norm FROM c_ti GROUP BY article_id",
    "c_tw": "SELECT term, article_id, ti, CASE WHEN norm > 0 THEN raw / norm ELSE 0 END AS w FROM c_ti JOIN c_tn USING (article_id)",
    "c_tq": "SELECT user_id, term, any_value(ti) AS ti FROM c_query JOIN c_ti USING (term) GROUP BY ALL",
    "c_tqn": "SELECT user_id, sqrt(sum(ti * ti)) AS norm FROM c_tq GROUP BY user_id",
    "c_th": """SELECT user_id, p.article_id, sum(q.ti * w) AS s FROM c_pairs p JOIN c_tw USING (article_id)
        JOIN c_tq q USING (user_id, term) GROUP BY ALL""",
}
_BANDS = {
    "c_levels": "SELECT clicks, (SELECT count(*) FROM c_pop p WHERE p.clicks > l.clicks) AS above FROM (SELECT DISTINCT clicks FROM c_pop) l",
    "c_band": """SELECT article_id, clicks, CASE WHEN clicks >= (SELECT min(clicks) FROM c_levels
        WHERE above <= (1 - 0.8::DOUBLE) * (SELECT count(*) FROM c_pop)) THEN 'head' ELSE 'tail' END AS band FROM c_pop""",
}
# Ids that come twice: every third article and vector is replaced by a later copy.
_LATE_ARTICLES = {"c_art": PARTS["c_art"].replace("split_part(text, chr(10), 1) AS title", "CASE WHEN doc_id % 3 = 0 THEN 'late ' ELSE '' END || split_part(text, chr(10), 1) AS title")
                  .replace("lang AS category", "CASE WHEN doc_id % 3 = 0 THEN 'late ' ELSE '' END || lang AS category")}
_LATE_VECTORS = {"c_dims": PARTS["c_dims"].replace("unnest(embedding)", "unnest(CASE WHEN vec_id % 3 = 0 THEN list_reverse(embedding) ELSE embedding END)")}
# Sides of fixed pseudo-random planes, and the buckets that follow from them.


def _planes(tables: int, bits: int) -> str:
    p = 2147483647
    return f"""SELECT t // {bits * 64} AS tab, (t // 64) % {bits} AS bit, t % 64 AS dim, ((x3 * x3 + t) % {p}) / {p}.0::DOUBLE - 0.5 AS v FROM (
        SELECT t, (x2 * 48271 + t) % {p} AS x3 FROM (SELECT t, (x1 * x1 + 12345) % {p} AS x2 FROM (
        SELECT t, (t * 40503 + 7919) % {p} AS x1 FROM (SELECT CAST(range AS BIGINT) AS t FROM range({tables * bits * 64})))))"""


_BALLS = {
    "c_planes": _planes(1, 5),
    "c_cell": """SELECT article_id, CAST(sum(CASE WHEN s > 0 THEN 1 << bit ELSE 0 END) AS BIGINT) AS cell FROM (
        SELECT article_id, bit, sum(x * v) AS s FROM c_unit JOIN c_planes USING (dim) GROUP BY ALL) GROUP BY article_id""",
    "c_cmean": "SELECT cell, dim, avg(x) AS m, count(*) AS n FROM c_unit JOIN c_cell USING (article_id) GROUP BY ALL",
    "c_centre": """SELECT cell, dim, n, CASE WHEN l > 0 THEN m / l ELSE 0 END AS value FROM c_cmean
        JOIN (SELECT cell, sqrt(sum(m * m)) AS l FROM c_cmean GROUP BY cell) USING (cell)""",
    "c_angle": """SELECT article_id, cell, acos(greatest(least(sum(x * value), 1.0::DOUBLE), -1.0::DOUBLE)) AS angle, sqrt(sum(x * x)) AS norm
        FROM c_unit JOIN c_cell USING (article_id) JOIN c_centre USING (cell, dim) GROUP BY ALL""",
}
_TABLES, _BITS, _PROBES = 48, 10, 9
_ANN = {
    "c_planes": _planes(_TABLES, _BITS),
    "c_acode": """SELECT article_id, tab, sum(CASE WHEN s > 0 THEN 1 << bit ELSE 0 END)::BIGINT AS code FROM (
        SELECT article_id, tab, bit, sum(x * v) AS s FROM c_unit JOIN c_planes USING (dim) GROUP BY ALL) GROUP BY ALL""",
    "c_uside": """SELECT *, row_number() OVER (PARTITION BY user_id, tab ORDER BY abs(s), bit) - 1 AS place FROM (
        SELECT user_id, tab, bit, sum(x * v) AS s FROM c_uvec JOIN c_readers USING (user_id) JOIN c_planes USING (dim) GROUP BY ALL)""",
    "c_flips": f"""SELECT m FROM (SELECT CAST(range AS BIGINT) AS m FROM range({1 << _BITS}))
        ORDER BY list_sum([(i + 1) * (i + 1) * ((m >> i) & 1) FOR i IN range({_BITS})]), m LIMIT {_PROBES}""",
    "c_probe": """SELECT DISTINCT user_id, tab, code FROM (SELECT user_id, tab, m, sum(CASE WHEN (s > 0) <> ((m >> place) & 1 = 1) THEN 1 << bit ELSE 0 END)::BIGINT AS code
        FROM c_uside, c_flips GROUP BY ALL)""",
    "c_near": "SELECT DISTINCT user_id, article_id FROM c_probe JOIN c_acode USING (tab, code)",
    "c_ann": """SELECT user_id, article_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, article_id) AS rank
        FROM (SELECT user_id, article_id, round(sum(u.x * v.x), 9) AS score FROM c_near JOIN c_uvec u USING (user_id) JOIN c_unit v USING (article_id, dim) GROUP BY ALL)
        QUALIFY rank <= 10""",
    "c_enough": "SELECT user_id FROM c_ann WHERE rank = 10",
}
_CODE = "CAST('0x' || substr(md5(term), 1, 8) AS BIGINT)"


def _hashed(dims: int) -> str:
    return f"""SELECT a.article_id, d.dim, coalesce(v, 0) AS raw FROM c_art a CROSS JOIN (SELECT CAST(dim AS BIGINT) AS dim FROM range({dims}) r(dim)) d
        LEFT JOIN (SELECT article_id, {_CODE} % {dims} AS dim, sum(CASE WHEN ({_CODE} // {dims}) % 2 = 0 THEN tf ELSE -tf END) AS v FROM c_tf GROUP BY ALL) h
        ON h.article_id = a.article_id AND h.dim = d.dim"""


def _store(extra: dict[str, str]) -> str:
    """(name, n_rows, digest) of the store tables; `extra` replaces building blocks of the default dataset."""
    def million(e: str) -> str:
        return f"CAST(round({e} * 1000000) AS BIGINT)"

    stored = {
        "articles": ("article_id, title, abstract, body, category", "c_art"), "users": ("user_id, history", "c_users"),
        "impressions": (f"impression_id, user_id, strftime(time, {STAMP}), clicked, unclicked, split", "c_imp JOIN c_split USING (event_id)"),
        "vectors": ("article_id, v", "(SELECT article_id, string_agg(CAST(round(raw * 1000) AS BIGINT), ' ' ORDER BY dim) AS v FROM c_dims GROUP BY article_id)"),
        "postings": (f"term, article_id, tf, dl, df, {million('idf')}, {million('weight')}", "c_post"), "docs": ("article_id, dl", "c_dl"),
        "stats": (f"n, {million('avgdl')}, 1500000, 750000", "c_stats")}
    return with_parts(" UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {cols})), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM {source}"
        for name, (cols, source) in stored.items()), extra)


# The raw strings drop fractions of seconds and have unreadable times, which belong to no split.
_TSV_STORE = {
    "c_max": "SELECT max(date_trunc('second', ts)) AS mx FROM c_ev WHERE k <> 50",
    "c_split": """SELECT event_id, CASE WHEN date_trunc('second', ts) > mx - INTERVAL 1 DAY THEN 'test' WHEN date_trunc('second', ts) > mx - INTERVAL 2 DAY
        THEN 'val' ELSE 'train' END AS split FROM c_ev, c_max WHERE k <> 50""",
    "c_art": "SELECT article_id, title, coalesce(abstract, '') AS abstract, '' AS body, category FROM c_news",
    "c_users": """SELECT CAST(user_id AS VARCHAR) AS user_id, arg_min(coalesce(history, ''), key) AS history FROM (
        SELECT e.user_id, history, {'late': k = 50, 'time': date_trunc('second', e.ts), 'id': CAST(event_id AS VARCHAR)} AS key
        FROM c_ev e LEFT JOIN c_histlist h USING (event_id)) GROUP BY user_id"""}
_LOG_STORE = {
    "c_art": "SELECT CAST(doc_id AS VARCHAR) AS article_id, text AS title, source AS abstract, '' AS body, CAST(length(source) AS VARCHAR) AS category FROM documents",
    "c_users": """SELECT CAST(user_id AS VARCHAR) AS user_id, array_to_string(arg_max(items, late), ' ') AS history FROM (
        SELECT e.user_id, split <> 'train' AS late, max([CAST(x AS VARCHAR) FOR x IN coalesce(items, [])]) AS items FROM c_ev e JOIN c_split USING (event_id) LEFT JOIN c_histlist h USING (event_id) GROUP BY ALL)
        GROUP BY user_id"""}


def _solved(tag: str, names: list[str], source: str, ridge: float) -> dict[str, str]:
    """Block c_fit<tag> (one column per name): the normal equations over `source`, solved by elimination step by step."""
    n = len(names)
    sums = [f"sum({a} * {b})" + (f" + {ridge}" if i == j else "") + f"::DOUBLE AS m{i}_{j}" for i, a in enumerate(names) for j, b in enumerate([*names, "label"])]
    blocks = {f"c_el{tag}0": f"SELECT {', '.join(sums)} FROM {source}"}
    for k in range(n):
        cells = [f"m{i}_{j} / m{k}_{k} AS m{i}_{j}" if i == k else f"m{i}_{j} - m{i}_{k} / m{k}_{k} * m{k}_{j} AS m{i}_{j}" for i in range(n) for j in range(n + 1)]
        blocks[f"c_el{tag}{k + 1}"] = f"SELECT {', '.join(cells)} FROM c_el{tag}{k}"
    return blocks | {f"c_fit{tag}": f"SELECT {', '.join(f'm{i}_{n} AS w_{name}' for i, name in enumerate(names))} FROM c_el{tag}{n}"}


_FEATURES = ["one", "pop", "seen", "logged"]
_ABLATION = {
    "c_feat": """SELECT c.row_id, c.pos, c.label, split, coalesce(hist_len, 0) AS hist_len, 1.0::DOUBLE AS one, ln(1 + coalesce(clicks, 0)::DOUBLE) AS pop,
        CASE WHEN h.article_id IS NULL THEN 0.0::DOUBLE ELSE 1.0 END AS seen, CASE WHEN c.label = 1 THEN k::DOUBLE ELSE 0 END AS logged
        FROM c_cands c JOIN c_split USING (event_id) JOIN c_ev e USING (event_id) LEFT JOIN c_pop p ON p.article_id = c.article_id
        LEFT JOIN (SELECT DISTINCT user_id, article_id FROM c_hist) h ON h.user_id = c.user_id AND h.article_id = c.article_id
        LEFT JOIN c_users u ON u.user_id = c.user_id""",
    "c_learn": "SELECT * FROM c_feat WHERE split = 'train'",
    "c_ablated": """SELECT 'all' AS model, row_id, hist_len, pos, label, '' AS category, round(one * w_one + pop * w_pop + seen * w_seen + logged * w_logged, 9) AS score FROM c_feat, c_fitall WHERE split = 'test'
        UNION ALL SELECT 'serving', row_id, hist_len, pos, label, '', round(one * w_one + pop * w_pop + seen * w_seen, 9) FROM c_feat, c_fitserving WHERE split = 'test'""",
    "c_valid": "SELECT * FROM c_metrics WHERE auc IS NOT NULL",
} | _solved("all", _FEATURES, "c_learn", 0.001) | _solved("serving", _FEATURES[:3], "c_learn", 0.001)


def _compared(one: str, two: str, tag: str) -> str:
    """Means of two models side by side, their difference, and its interval over replicates that weight both alike."""
    def both(source: str, keys: str) -> str:
        return f"""SELECT {keys}, any_value(value) FILTER (model = '{one}') AS a, any_value(value) FILTER (model = '{two}') AS b FROM {source} GROUP BY ALL"""

    return f"""SELECT m.slice, m.metric, round(m.a, 6) AS "{one}", round(m.b, 6) AS "{two}", round(m.a - m.b, 6) AS difference,
        round(quantile_cont(r.a - r.b, 0.025), 6) AS low, round(quantile_cont(r.a - r.b, 0.975), 6) AS high
        FROM ({both(f'c_ml{tag}', 'slice, metric')}) m JOIN ({both(f'c_rl{tag}', 'slice, metric, rep')}) r ON r.slice = m.slice AND r.metric = m.metric GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    w = with_parts
    same_imp = f"SELECT impression_id, strftime(time, {STAMP}) AS time FROM c_imp"
    norms = "SELECT article_id, count(*) AS dims, round(sqrt(sum(raw * raw)), 6) AS norm FROM c_dims GROUP BY article_id"
    tsv_behaviors = f"SELECT impression_id, user_id, {BEHAVIOR_TIME} AS time, history, impressions FROM c_imp LEFT JOIN (SELECT event_id, history FROM c_histlist) USING (event_id)"
    split_rows = "FROM c_imp JOIN c_split USING (event_id)"
    top = "SELECT user_id, article_id, rank, round(score, 6) AS score FROM "
    report = _slices("c_metrics", METRICS, metric_parts("c_models"))
    bare = "regexp_replace(impressions, '-[01]', '', 'g')"
    hist_ids = "coalesce(history, '')"
    return {
        "read_news_tsv": w("SELECT article_id, category, subcategory, title, abstract, url, title_entities FROM c_news"),
        "read_behaviors_tsv": w(tsv_behaviors),
        "read_vec": w(norms.replace("article_id,", "article_id AS entity_id,")),
        "read_articles_parquet": "SELECT doc_id AS article_id, text AS title, '' AS subtitle, '' AS body, lang AS category_str FROM documents",
        "read_history_parquet": w(f"SELECT CAST(e.user_id AS VARCHAR) AS user_id, {hist_ids} AS history FROM c_ev e LEFT JOIN c_histlist h USING (event_id)"),
        "read_behaviors_parquet": w(f"SELECT impression_id, user_id, strftime(time, {STAMP}) AS time, inview, clicked FROM c_imp"),
        "load_store": _store({}),
        "scan_many": "SELECT r AS source_rank, event_type, count(*) AS n_rows, max(event_id) AS last_id FROM events, (SELECT CAST(0 AS INTEGER) AS r UNION ALL SELECT 1) GROUP BY ALL",
        "read_all_datasets": w(f"SELECT 'logs_' || split AS dataset, impression_id, user_id, impressions {split_rows}"),
        "read_test_impressions": w("""SELECT impression_id, c_imp.user_id, coalesce(len(items), 0) AS n_history, inview AS candidates
            FROM c_imp LEFT JOIN c_histlist h USING (event_id) UNION ALL SELECT impression_id, user_id, -1, inview FROM c_imp"""),
        "history_for_test": w("SELECT coalesce(l.user_id, u.user_id) AS user_id, coalesce(l.history, u.history) AS history FROM c_late l FULL JOIN c_users u ON l.user_id = u.user_id"),
        "profile_files": """SELECT 'events.parquet' AS file_name, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM events
            UNION ALL SELECT 'documents.parquet', count(*), 5 FROM documents UNION ALL SELECT 'embeddings.parquet', count(*), 3 FROM embeddings""",
        "write_table": w(f"SELECT 'one' AS dataset, impression_id, user_id, strftime(time, {STAMP}) AS time, clicked AS clicked_articles, unclicked AS unclicked_articles FROM c_imp"),
        "write_splits": w(f"SELECT 'one' AS dataset, split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users {split_rows} GROUP BY ALL"),
        "write_index": w("""SELECT term, article_id, tf, dl, round(weight, 6) AS weight, round(idf, 6) AS idf FROM c_post UNION ALL SELECT '', article_id, NULL, dl, NULL, NULL FROM c_dl
            UNION ALL SELECT '', '', n, NULL, round(avgdl, 6), CAST(0.75 AS DOUBLE) FROM c_stats"""),
        "write_embeddings": w(norms),
        "write_metrics": report,
        "write_predictions": w(f"SELECT value FROM ({POP_LINES})"),
        "unify_articles": w("""SELECT article_id, title, coalesce(abstract, '') AS abstract, '' AS body, category, 'tsv' AS kind FROM c_news
            UNION ALL SELECT CAST(doc_id AS VARCHAR), text, source, '', lang, 'parquet' FROM documents"""),
        "parse_time": w(f"SELECT impression_id, CASE WHEN k <> 50 THEN strftime(time, {STAMP}) END AS time FROM c_imp"),
        "parse_labeled_impressions": w("SELECT impression_id, clicked, unclicked FROM c_imp"),
        "parse_history": w(f"SELECT CAST(e.event_id AS VARCHAR) AS impression_id, replace({hist_ids}, ' ', ',') AS ids, coalesce(len(items), 0) AS n_ids FROM c_ev e LEFT JOIN c_histlist h USING (event_id)"),
        "parse_candidates": w("SELECT impression_id, replace(inview, ' ', ',') AS ids FROM c_imp"),
        "ids_to_string": w("SELECT event_id AS impression_id, replace(inview, ' ', '|') AS ids FROM c_imp"),
        "unclicked": w("SELECT event_id AS impression_id, unclicked FROM c_imp"),
        "full_text": w("SELECT article_id, title || ' ' || abstract AS full_text FROM c_art"),
        "tokenize": w("SELECT article_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS BIGINT) AS n_tokens FROM c_toklist"),
        "list_len": w("SELECT event_id AS impression_id, CAST(10 AS BIGINT) AS n_inview, CAST(n_clicked AS BIGINT) AS n_clicked FROM c_imp"),
        "string_helpers": w("""SELECT CAST(event_id AS VARCHAR) AS impression_id, aid || '-' || label AS item, CAST(length(aid || '-' || label) AS BIGINT) AS n_chars,
            label = 1 AS is_click, CASE WHEN label = 1 THEN CAST(aid AS VARCHAR) ELSE aid || '-0' END AS stripped FROM c_cand0"""),
        "parse_entities": w("""SELECT article_id, source AS label, 'S' AS entity_type, 'Q' || length(source) AS wikidata_id, CAST(0.5 AS DOUBLE) AS confidence FROM c_news
            UNION ALL SELECT article_id, 'l', 'L', 'Q' || doc_id % 7, 1.0 FROM c_news"""),
        "click_rate": w("SELECT impression_id, CAST(n_clicked AS BIGINT) AS n_clicks, round(n_clicked / 10, 6) AS click_rate FROM c_imp"),
        "rename_and_default": w("SELECT impression_id, article_id AS clicked_id, coalesce(gender, -1) AS gender, 'none' AS split_name FROM c_log WHERE article_id IS NOT NULL"),
        "explode_with_pos": w("SELECT event_id AS impression_id, j AS pos, aid AS article_id FROM c_cand0"),
        "explode_ids": w("SELECT impression_id, coalesce(article_id, -1) AS article_id FROM c_log"),
        "unnest": w("SELECT impression_id, device_type AS device, is_sso_user FROM c_log"),
        "has_labels": w("SELECT 'labeled' AS kind, true AS has_labels, count(*) AS n_rows FROM c_imp UNION ALL SELECT 'bare', false, count(*) FROM c_imp"),
        "between_times": w(f"{same_imp} WHERE time > TIMESTAMP '2024-01-10' AND time <= TIMESTAMP '2024-01-20'"),
        "only_labeled": w("SELECT impression_id, v AS kept_by FROM c_imp, (SELECT 'clicked' AS v UNION ALL SELECT 'clicked_and_not') WHERE n_clicked > 0"),
        "with_history": w("SELECT impression_id, user_id FROM c_imp JOIN c_users USING (user_id) WHERE hist_len > 0"),
        "all_candidates_known": w("SELECT row_id, count(*) AS n_candidates FROM c_cands LEFT JOIN c_norm USING (article_id) GROUP BY row_id HAVING count(norm) = count(*)"),
        "only_clicked_items": w("SELECT aid || '-1' AS item, count(*) AS n_rows FROM c_cand0 WHERE label = 1 GROUP BY ALL"),
        "select_dataset": w("""SELECT d.dataset, count(*) AS n_rows, kind FROM c_imp, (SELECT 'mind_log' AS dataset UNION ALL SELECT 'ebnerd_log') d,
            (SELECT 'mind' AS kind UNION ALL SELECT 'ebnerd' UNION ALL SELECT 'both') k
            WHERE (d.dataset = 'mind_log' OR n_clicked > 0) AND (kind = 'both' OR starts_with(d.dataset, kind)) GROUP BY ALL"""),
        "slice_by_history": w("SELECT impression_id, hist_len, CASE WHEN hist_len < 5 THEN 'cold' ELSE 'warm' END AS slice FROM c_imp JOIN c_users USING (user_id)"),
        "attach_history": w("SELECT impression_id, history FROM c_imp JOIN c_users USING (user_id)"),
        "history_text": w("SELECT DISTINCT user_id, article_id, title || ' ' || abstract AS text FROM c_hist JOIN c_art USING (article_id)"),
        "known_history": w("SELECT user_id, article_id, count(*) AS n FROM c_hist JOIN c_norm USING (article_id) GROUP BY ALL"),
        "attach_vectors": w("""SELECT policy, row_id, article_id, norm IS NOT NULL AS known FROM c_test LEFT JOIN c_norm USING (article_id),
            (SELECT 'null' AS policy UNION ALL SELECT 'drop') WHERE policy = 'null' OR norm IS NOT NULL""", ALL),
        "match_terms": w("SELECT user_id, article_id, term, tf, round(weight, 6) AS weight FROM c_match", ALL),
        "match_terms_stored": w("SELECT user_id, article_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS total_tf, round(sum(weight), 6) AS weight FROM c_match GROUP BY ALL", ALL),
        "attach_popularity": w("SELECT row_id, article_id, coalesce(clicks, 0) AS clicks FROM c_cands LEFT JOIN c_pop USING (article_id)"),
        "attach_category": w("SELECT row_id, article_id, coalesce(category, 'unknown') AS category FROM c_semrank LEFT JOIN c_art USING (article_id) WHERE rank <= 5", ALL),
        "first_history": w("""SELECT CAST(user_id AS VARCHAR) AS user_id, arg_min(coalesce(history, ''), key) AS history FROM (
            SELECT e.user_id, history, {'late': k = 50, 'time': date_trunc('second', e.ts), 'id': CAST(event_id AS VARCHAR)} AS key
            FROM c_ev e LEFT JOIN c_histlist h USING (event_id)) GROUP BY user_id"""),
        "distinct_users": w("""SELECT CAST(e.user_id AS VARCHAR) AS user_id, array_to_string(max(coalesce(items, [])), ' ') AS history
            FROM c_ev e LEFT JOIN c_histlist h USING (event_id) GROUP BY ALL"""),
        "latest_users": w("SELECT CAST(e.user_id AS VARCHAR) AS user_id, arg_max(coalesce(history, ''), event_id) AS history FROM c_ev e LEFT JOIN c_histlist h USING (event_id) GROUP BY ALL"),
        "max_time": w(f"SELECT strftime(mx, {STAMP}) AS max_time FROM c_max"),
        "term_freq": w("SELECT article_id, term, tf FROM c_tf"),
        "corpus_stats": w("SELECT n, round(avgdl, 6) AS avgdl, CAST(1.5 AS DOUBLE) AS k1, CAST(0.75 AS DOUBLE) AS b FROM c_stats"),
        "idf": w("SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM c_df, c_stats"),
        "popularity_counts": w("SELECT article_id, clicks FROM c_popall"),
        "popularity_from_behaviors": w("SELECT article_id, clicks FROM c_popall"),
        "popularity_summary": w("SELECT max(clicks) AS max_clicks, count(*) AS n_articles FROM c_popall"),
        "value_counts": "SELECT lang AS category, source AS subcategory, count(*) AS n_rows FROM documents GROUP BY ALL",
        "null_profile": w(_nulls(LOG_COLUMNS, "c_log")),
        "distinct_profile": w(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM c_log" for c in ("impression_id", "user_id", "session_id"))),
        "distinct_profile_sketch": w(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, count(DISTINCT {c}) AS n_distinct, true AS within FROM c_log" for c in ("impression_id", "user_id", "session_id"))),
        "distinct_profile_approx": w(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS within FROM c_log" for c in ("impression_id", "user_id", "session_id"))),
        "quantile_sketch": w(" UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS q, count(*) AS n, CAST(min({e}) AS DOUBLE) AS low, CAST(max({e}) AS DOUBLE) AS high, true AS within
            FROM c_log WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""" for c, e in (("read_time", "read_time"), ("value", "impression_id")) for q in (0.1, 0.5, 0.95))),
        "summary_stats": w(_summary([("n_inview", "len(string_split(inview, ' '))"), ("n_clicked", "n_clicked"), ("read_time", "read_time"),
                                     ("scroll_percentage", "scroll_percentage")], "c_log")),
        "exact_quantiles": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS q, round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value FROM events"
            for c in ("value", "event_id") for q in (0.1, 0.5, 0.95)),
        "share": w(" UNION ALL ".join(f"SELECT '{c}' AS column_name, round(avg(CAST({c} AS INTEGER)), 6) AS share_true FROM c_log" for c in ("is_sso_user", "is_subscriber"))),
        "activity_per_user": w(_summary([("n_impressions", "c")], "(SELECT count(*) AS c FROM c_imp GROUP BY user_id)")),
        "most_active_users": w("SELECT user_id, count(*) AS n_impressions FROM c_imp GROUP BY user_id ORDER BY 2 DESC, 1 LIMIT 5"),
        "clicks_per_impression": w("SELECT CAST(n_clicked AS BIGINT) AS n_clicked, count(*) AS n_impressions FROM c_imp GROUP BY ALL"),
        "histogram": """WITH b AS (SELECT min(n_chars)::DOUBLE AS a, (max(n_chars) - min(n_chars)) / 50::DOUBLE AS wd FROM documents),
            p AS (SELECT least(CAST(floor((n_chars - a) / wd) AS BIGINT) + 1, 50) AS bin, a, wd FROM documents, b)
            SELECT bin, round(a + (bin - 1) * wd, 6) AS low, round(a + bin * wd, 6) AS high, count(*) AS n_rows FROM p GROUP BY ALL""",
        "mean_vectors": w("SELECT CAST(grp AS BIGINT) AS label, dim, round(avg(raw), 6) AS value FROM c_dims GROUP BY ALL"),
        "ranks_to_list": w("""SELECT row_id, string_agg(rank, ' ' ORDER BY pos) AS ranks FROM (SELECT row_id, pos,
            row_number() OVER (PARTITION BY row_id ORDER BY coalesce(clicks, 0) DESC, pos) AS rank FROM c_test LEFT JOIN c_pop USING (article_id)) GROUP BY row_id""", ALL),
        "split_sizes": w("SELECT split, count(*) AS n_rows FROM c_split GROUP BY split"),
        "mean_by_slice": report,
        "rank_by_popularity": w("""SELECT row_id, article_id, coalesce(clicks, 0) AS clicks, row_number() OVER (PARTITION BY row_id
            ORDER BY coalesce(clicks, 0) DESC, pos) AS rank FROM c_cands LEFT JOIN c_pop USING (article_id)"""),
        "ranks_from_scores": w("SELECT row_id, article_id, rank FROM c_semrank", ALL),
        "order_by_score": w("SELECT row_id, string_agg(article_id, ' ' ORDER BY rank) AS ordered FROM c_lexrank GROUP BY row_id", ALL),
        "tie_groups": w("""SELECT row_id, article_id, rank() OVER (PARTITION BY row_id ORDER BY c DESC) AS tie_rank, count(*) OVER (PARTITION BY row_id, c) AS tie_size,
            round(count(*) OVER (PARTITION BY row_id) - rank() OVER (PARTITION BY row_id ORDER BY c DESC) + 1
            - (count(*) OVER (PARTITION BY row_id, c) - 1) / 2, 6) AS avg_rank
            FROM (SELECT t.*, coalesce(clicks, 0) AS c FROM c_test t LEFT JOIN c_pop USING (article_id))""", ALL),
        "sort_by_time": w(same_imp),
        "top_n": w("SELECT article_id, clicks FROM c_popall ORDER BY clicks DESC, article_id LIMIT 10"),
        "top_k": w("SELECT row_id, article_id, rank FROM c_semrank WHERE rank <= 5", ALL),
        "head": w("SELECT impression_id, user_id FROM c_imp ORDER BY time, impression_id LIMIT 5"),
        "union_all": w("SELECT split, count(*) * CASE WHEN split = 'test' THEN 2 ELSE 1 END AS n_rows FROM c_split GROUP BY split"),
        "candidate_set": w("SELECT impression_id, string_agg(article_id, ' ' ORDER BY pos) AS candidates FROM c_imp JOIN c_cands USING (event_id) GROUP BY ALL"),
        "labeled_candidates": w("SELECT row_id, user_id, pos, article_id, CAST(label AS BIGINT) AS label FROM c_cands"),
        "hits": w("SELECT row_id, CAST(sum(CASE WHEN rank <= 3 THEN label ELSE 0 END) AS BIGINT) AS n_hits, CAST(sum(label) AS BIGINT) AS n_clicked FROM c_semrank GROUP BY row_id", ALL),
        "list_minus": w("""SELECT e.event_id, coalesce(string_agg(aid, ' ' ORDER BY pos), '') AS not_in_view FROM c_ev e LEFT JOIN (
            SELECT event_id, aid, min(pos) AS pos FROM c_hist0 h WHERE NOT EXISTS (SELECT 1 FROM c_cand0 c WHERE c.event_id = h.event_id AND c.aid = h.aid)
            GROUP BY ALL) USING (event_id) GROUP BY ALL"""),
        "column_presence": w(_presence()),
        "build_bm25_index": w("SELECT term, article_id, tf, dl, df, round(idf, 6) AS idf, round(weight, 6) AS weight FROM c_post"),
        "history_query": w("SELECT user_id, term FROM c_query"),
        "bm25_score": w("SELECT row_id, article_id, lexical AS score FROM c_test JOIN c_lex USING (user_id, article_id)", ALL),
        "l2_normalize": w("SELECT article_id, dim, round(x, 6) AS value FROM c_unit"),
        "user_vector": w("SELECT u.user_id, d.dim, round(coalesce(x, 0), 6) AS value FROM c_users u CROSS JOIN (SELECT CAST(dim AS BIGINT) AS dim FROM range(64) r(dim)) d LEFT JOIN c_uvec v ON v.user_id = u.user_id AND v.dim = d.dim"),
        "semantic_score": w("""SELECT row_id, article_id, CAST(coalesce(semantic, CASE WHEN k.user_id IS NULL THEN 0 ELSE -999 END) AS DOUBLE) AS score
            FROM c_test JOIN c_sem USING (user_id, article_id) LEFT JOIN c_known k USING (user_id)""", ALL),
        "popularity_score": w(POP_LINES),
        "embed_articles": w("""SELECT article_id, d.dim, CAST(CASE d.dim WHEN 0 THEN length(t) WHEN 1 THEN length(t) - length(replace(t, ' ', ''))
            ELSE length(t) - length(replace(t, 'e', '')) END AS DOUBLE) AS value FROM (SELECT article_id, title || ' ' || abstract AS t FROM c_art), (SELECT CAST(dim AS BIGINT) AS dim FROM range(3) r(dim)) d"""),
        "hash_encoder_vectors": w(f"""SELECT a.article_id, d.dim, CAST(coalesce(v, 0) AS DOUBLE) AS value FROM c_art a CROSS JOIN (SELECT CAST(dim AS BIGINT) AS dim FROM range(32) r(dim)) d
            LEFT JOIN (SELECT article_id, {_CODE} % 32 AS dim, sum(CASE WHEN ({_CODE} // 32) % 2 = 0 THEN tf ELSE -tf END) AS v FROM c_tf GROUP BY ALL) h
            ON h.article_id = a.article_id AND h.dim = d.dim"""),
        "exact_vector_index": w("SELECT article_id, cell, round(angle, 6) AS angle, round(norm, 6) AS norm FROM c_angle", _BALLS),
        "vector_cells": w("""SELECT cell, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value, round(radius, 6) AS radius, n
            FROM c_centre JOIN (SELECT cell, max(angle) AS radius FROM c_angle GROUP BY cell) USING (cell)""", _BALLS),
        "rank_candidates": w("SELECT row_id, article_id, rank FROM c_lexrank", ALL),
        "generate_predictions": w(_semantic_lines("user_id", "c_sd"), _SEM_DOTS_USER),
        "generate_predictions_inline": w(_semantic_lines("row_id", "c_sd"), _SEM_DOTS_ROW),
        "temporal_split": w("SELECT CAST(event_id AS VARCHAR) AS impression_id, split FROM c_split"),
        "temporal_split_days": w("""SELECT CAST(event_id AS VARCHAR) AS impression_id, CASE WHEN ts > mx - INTERVAL 3 DAY THEN 'test'
            WHEN ts > mx - INTERVAL 8 DAY THEN 'val' ELSE 'train' END AS split FROM c_ev, c_max"""),
        "assert_split_order": "SELECT 'train' AS earlier, 'val' AS later, true AS ok UNION ALL SELECT 'val', 'test', true",
        "build_feature_store": w("SELECT coalesce(l.user_id, u.user_id) AS user_id, coalesce(l.history, u.history) AS history FROM c_late l FULL JOIN c_users u ON l.user_id = u.user_id"),
        "build_all": _store(_TSV_STORE | {"c_dims": _hashed(64)}),
        "build_all_parquet": _store(_LOG_STORE | {"c_dims": _hashed(64)}),
        "lexical_recall": w(f"SELECT row_id, {R135} FROM c_reclexical", LEX_RECALL),
        "semantic_recall": w(f"SELECT row_id, {R135} FROM c_recsemantic", SEM_RECALL),
        "mean_recall": w("SELECT round(avg(recall_1), 6) AS recall_1, round(avg(recall_3), 6) AS recall_3, round(avg(recall_5), 6) AS recall_5 FROM c_recsemantic", SEM_RECALL),
        "auc": _metric("round(auc, 6) AS auc"),
        "mrr": _metric("round(mrr, 6) AS mrr"),
        "ndcg_at": _metric("round(ndcg_5, 6) AS ndcg_5, round(ndcg_10, 6) AS ndcg_10"),
        "category_diversity": w("""SELECT row_id, round(count(DISTINCT coalesce(category, 'unknown')) / count(*), 6) AS category_diversity_5
            FROM c_semrank LEFT JOIN c_art USING (article_id) WHERE rank <= 5 GROUP BY row_id""", ALL),
        "evaluate_impressions": _metrics_sql("SELECT model, row_id, hist_len, " + ", ".join(f"round({m}, 6) AS {m}" for m in METRICS) + " FROM c_metrics"),
        "slice_report": report,
        "compare_models": f"SELECT slice, metric, max(value) FILTER (model = 'lexical') AS lexical, max(value) FILTER (model = 'semantic') AS semantic FROM ({report}) GROUP BY ALL",
        "bm25_retrieve": w(f"{top} c_ltop"),
        "vector_retrieve": w(f"{top} c_vtop"),
        "ann_retrieve": w(f"{top} c_ann WHERE user_id IN (SELECT user_id FROM c_enough) UNION ALL {top} c_vtop WHERE user_id NOT IN (SELECT user_id FROM c_enough)", _ANN),
        "intra_list_diversity": w("""SELECT user_id, round(CASE WHEN n > 1 THEN 1 - (sum(s * s) - n) / (n * (n - 1)) ELSE 0 END, 6) AS ild FROM (
            SELECT user_id, dim, count(*) AS n, sum(x) AS s FROM c_vtop JOIN c_unit USING (article_id) GROUP BY ALL) GROUP BY user_id, n"""),
        "novelty": w("""SELECT user_id, round(avg(-log2((coalesce(clicks, 0) + 1) / ((SELECT sum(clicks) FROM c_pop) + (SELECT count(*) FROM documents)))), 6) AS novelty
            FROM c_vtop LEFT JOIN c_pop USING (article_id) GROUP BY user_id"""),
        "coverage": w("""SELECT model, round(count(DISTINCT article_id) / (SELECT count(*) FROM documents), 6) AS coverage FROM (
            SELECT 'lexical' AS model, article_id FROM c_ltop UNION ALL SELECT 'semantic', article_id FROM c_vtop) SEMI JOIN c_art USING (article_id) GROUP BY model"""),
        "bootstrap_ci": w("""SELECT model, metric, round(quantile_cont(value, 0.025), 6) AS low, round(quantile_cont(value, 0.975), 6) AS high
            FROM c_replong GROUP BY ALL""", metric_parts("c_popmodel") | BOOT_PARTS | ALL),
        "harness_report": w("""SELECT model, slice, metric, round(value, 6) AS value, round(low, 6) AS low, round(high, 6) AS high FROM (
            SELECT * FROM c_ciimp UNION ALL SELECT * FROM c_cilist UNION ALL SELECT model, slice, 'coverage', value, NULL, NULL FROM c_cov)""",
            metric_parts("c_models") | _LISTS | _intervals("c_metrics", "row_id", METRICS, "imp") | _intervals("c_lists", "user_id", ("ild", "novelty"), "list")),
        "compare_models_interval": w(_compared("lexical", "semantic", "imp"), metric_parts("c_models") | _intervals("c_metrics", "row_id", METRICS, "imp")),
        "serving_time_ablation": w(_compared("all", "serving", "abl"), metric_parts("c_ablated") | _ABLATION | _intervals("c_valid", "row_id", BOOT_NAMES, "abl", 500)),
        "head_tail": w("SELECT article_id, clicks, band FROM c_band", _BANDS),
        "hits_by_band": w("""SELECT 'semantic' AS model, coalesce(band, 'tail') AS band, CAST(sum(CASE WHEN rank <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_hits, count(*) AS n_clicked
            FROM c_semrank LEFT JOIN c_band USING (article_id) WHERE label = 1 GROUP BY ALL""", _BANDS | ALL),
        "recency_features": w("SELECT user_id, count(*) AS n_clicks, round(min(age), 6) AS last_click_age, round(sum(exp(-age / 604800.0::DOUBLE)), 6) AS decay_sum FROM c_age GROUP BY user_id"),
        "recency_vectors": w("""SELECT user_id, dim, round(sum(wt * raw) / sum(wt), 6) AS value FROM (SELECT user_id, article_id, exp(-age / 604800.0::DOUBLE) AS wt FROM c_age)
            JOIN c_dims USING (article_id) GROUP BY ALL"""),
        "recency_at_impression": w("""SELECT i.impression_id, i.user_id, count(click_time) AS n_clicks, round(min(epoch_us(time) / 1e6 - epoch_us(click_time) / 1e6), 6) AS last_click_age,
            round(coalesce(sum(exp(-(epoch_us(time) / 1e6 - epoch_us(click_time) / 1e6) / 172800.0::DOUBLE)), 0), 6) AS decay_sum
            FROM c_imp i LEFT JOIN c_clicks c ON c.user_id = i.user_id AND c.click_time < i.time GROUP BY i.impression_id, i.user_id"""),
        "session_features": w("""WITH g AS (SELECT impression_id, user_id, epoch_us(time) / 1e6 AS t, (n_clicked > 0)::INTEGER AS clicked,
                epoch_us(time) / 1e6 - lag(epoch_us(time) / 1e6) OVER (PARTITION BY user_id ORDER BY time, impression_id) AS gap FROM c_imp),
            s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, impression_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
            SELECT impression_id, user_id, CAST(session AS BIGINT) AS session, row_number() OVER v AS position,
                CAST(coalesce(sum(clicked) OVER (v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS n_before_clicked,
                count(*) OVER a AS session_length, round(max(t) OVER a - min(t) OVER a, 6) AS session_seconds, round(avg(clicked) OVER a, 6) AS session_click_rate
            FROM s WINDOW a AS (PARTITION BY user_id, session), v AS (PARTITION BY user_id, session ORDER BY t, impression_id)"""),
        "article_features": w("""SELECT article_id, category, subcategory, array_to_string(list_sort(list_distinct(['Q' || length(source), 'Q' || doc_id % 7])), ' ') AS entities,
            CAST(len(list_distinct(['Q' || length(source), 'Q' || doc_id % 7])) AS BIGINT) AS n_entities FROM c_news"""),
        "entity_vectors": w("""WITH e AS (SELECT DISTINCT article_id, unnest(list_distinct([length(source), doc_id % 7])) AS id FROM c_news),
            k AS (SELECT article_id, count(*) AS n_known FROM e JOIN c_norm v ON v.article_id = CAST(e.id AS VARCHAR) GROUP BY ALL)
            SELECT e.article_id, n_known, dim, round(avg(raw), 6) AS value FROM e JOIN c_dims d ON d.article_id = CAST(e.id AS VARCHAR) JOIN k ON k.article_id = e.article_id GROUP BY ALL""".replace("article_id, count(*)", "e.article_id, count(*)")),
        "store_features": w("""SELECT article_id AS id, array_to_string(list_sort(list_distinct(['Q' || length(source), 'Q' || doc_id % 7])), ' ') AS entities,
            CAST(len(list_distinct(['Q' || length(source), 'Q' || doc_id % 7])) AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS last_click_age, CAST(NULL AS DOUBLE) AS decay_sum FROM c_news
            UNION ALL SELECT 'user ' || user_id, '', count(*), round(min(age), 6), round(sum(exp(-age / 604800.0::DOUBLE)), 6) FROM (
                SELECT user_id, epoch_us(mx - INTERVAL 2 DAY) / 1e6 - epoch_us(click_time) / 1e6 AS age FROM c_clicks, c_max WHERE click_time <= mx - INTERVAL 2 DAY) GROUP BY user_id"""),
        "leakage_report": w("""SELECT 'history_at_or_after_impression' AS "check", split, count(*) AS n_rows, count_if(coalesce(last_click >= time, false))::BIGINT AS n_leaks
            FROM c_imp JOIN c_split USING (event_id) LEFT JOIN (SELECT user_id, max(click_time) AS last_click FROM c_clicks GROUP BY user_id) USING (user_id) GROUP BY split
            UNION ALL SELECT 'candidate_published_later', split, count(*), count_if(coalesce(TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (n_chars % 720) > c.ts, false))::BIGINT
            FROM c_cand0 c JOIN c_split USING (event_id) LEFT JOIN documents d ON d.doc_id = c.aid GROUP BY split"""),
        "serving_time_view": w("SELECT device_type, count(*) AS n_rows, CAST(sum(n_clicked) AS BIGINT) AS n_clicks, CAST(11 AS BIGINT) AS n_columns FROM c_log GROUP BY device_type"),
        "tfidf_score": w("""SELECT user_id, article_id, round(CASE WHEN norm > 0 THEN round(coalesce(s, 0) / norm, 9) ELSE 0 END, 7) AS score
            FROM c_pairs LEFT JOIN c_th USING (user_id, article_id) LEFT JOIN c_tqn USING (user_id)""", _TFIDF | ALL),
        "recall_by_slice": _slices("c_recall", ("recall_1", "recall_3", "recall_5"), LEX_RECALL | SEM_RECALL | {
            "c_recall": """SELECT 'lexical' AS model, hist_len, recall_1, recall_3, recall_5 FROM c_reclexical JOIN c_users USING (user_id)
                UNION ALL SELECT 'semantic', hist_len, recall_1, recall_3, recall_5 FROM c_recsemantic JOIN c_users USING (user_id)"""}),
        "word_vectors": w(f"""SELECT a.article_id, d.dim, round(coalesce(value / nullif(sqrt(sum(value * value) OVER (PARTITION BY a.article_id)), 0), 0), 6) AS value FROM c_art a CROSS JOIN (SELECT CAST(dim AS BIGINT) AS dim FROM range(16) r(dim)) d
            LEFT JOIN (SELECT article_id, dim, sum(tf * v) / any_value(dl) AS value FROM c_tf JOIN c_dl USING (article_id) JOIN c_wv USING (term) GROUP BY ALL) m
            ON m.article_id = a.article_id AND m.dim = d.dim""", {
            "c_wsketch": f"SELECT article_id, {_CODE} % 16 AS dim, sum(CASE WHEN ({_CODE} // 16) % 2 = 0 THEN tf ELSE -tf END)::DOUBLE AS v FROM c_tf GROUP BY ALL",
            "c_wv": "SELECT term, dim, sum(tf * v) AS v FROM c_tf JOIN c_wsketch USING (article_id) GROUP BY ALL"}),
        "build_bm25_index_repeats": w("SELECT term, article_id, tf, dl, df, round(idf, 6) AS idf, round(weight, 6) AS weight FROM c_post", _LATE_ARTICLES),
        "index_append": w("SELECT term, article_id, tf, dl, df, round(idf, 6) AS idf, round(weight, 6) AS weight FROM c_post", _LATE_ARTICLES),
        "index_compact": w("SELECT article_id, dl, n, round(avgdl, 6) AS avgdl FROM c_dl, c_stats", _LATE_ARTICLES),
        "semantic_score_repeats": w("""SELECT row_id, article_id, CAST(coalesce(semantic, CASE WHEN k.user_id IS NULL THEN 0 ELSE -999 END) AS DOUBLE) AS score
            FROM c_test JOIN c_sem USING (user_id, article_id) LEFT JOIN c_known k USING (user_id)""", _LATE_VECTORS | ALL),
        "attach_category_repeats": w("SELECT row_id, pos, article_id, coalesce(category, 'unknown') AS category FROM c_test LEFT JOIN c_art USING (article_id)", _LATE_ARTICLES | ALL),
        "retrieval_recall": w("SELECT model, round(avg(recall_50), 6) AS recall_50, round(avg(recall_100), 6) AS recall_100, round(avg(recall_200), 6) AS recall_200 FROM c_deep GROUP BY model", _DEEP),
        "retrieval_recall_by_slice": _slices("c_deep", ("recall_50", "recall_100", "recall_200"), _DEEP,
            " UNION ALL SELECT model, band, metric, round(avg(value), 6) FROM c_bandlong GROUP BY ALL"),
        "recent_query": w("""SELECT DISTINCT user_id, term FROM (SELECT user_id, article_id FROM c_hist JOIN c_users USING (user_id) WHERE pos >= hist_len - 3) JOIN c_tf USING (article_id)"""),
    }
