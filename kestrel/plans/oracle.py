"""Independent SQL statements of the driver queries, run by DuckDB on the same parquet tables.

They are written from the tables directly (not from kestrel's code path) so that they check the
whole chain: derived lines, parsing, joins and aggregates.  Column names and types match the
Spark results.
"""

from __future__ import annotations

from collections.abc import Sequence

from kestrel.operators.mentions import DEFAULT_BLOCK
from kestrel.plans.tables import (COUNT_TERM, ETA, PAIR_BLOCK, PER_STRATUM, PRIORITIES, SEED, SPREAD, TERMS,
                                  TEXT_BLOCK)

KMEANS_STEPS = 24  # unrolled updates; the fit needs 3-4 at the driver scales, the cap is 120;
# the statements raise if the chain has not converged by then
BLOCK = DEFAULT_BLOCK


def _s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Sequence[str]) -> str:
    return "[" + ", ".join(_s(v) for v in values) + "]"


TERM_LIST = _list(TERMS)
PRIO_LIST = _list(PRIORITIES)
SCORE = "CAST(trunc(l_quantity - 25) AS INTEGER)"

POSTINGS_CTE = f"""postings AS (
  SELECT term, doc_id FROM (
    SELECT doc_id, unnest(list_intersect(string_split(text, ' '), {TERM_LIST})) AS term FROM documents))"""

COUNTS_CTE = "counts AS (SELECT term, count(*) AS n FROM postings GROUP BY term)"

VEC_CTES = f"""scored AS (
  SELECT o.o_orderkey AS id, o.o_orderpriority AS tags, greatest(0, max({SCORE})) AS high_score
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_orderkey, o.o_orderpriority),
vec AS (
  SELECT id, CAST((list_position({PRIO_LIST}, tags) - 1) * {SPREAD} AS INTEGER) AS x, high_score AS y
  FROM scored WHERE list_position({PRIO_LIST}, tags) IS NOT NULL)"""

SAMPLE_CTE = f"""smp AS (
  SELECT id, x, y FROM (
    SELECT id, x, y, row_number() OVER (PARTITION BY x ORDER BY md5({_s(SEED)} || CAST(id AS VARCHAR)), id) AS rn
    FROM vec) WHERE rn <= {PER_STRATUM})"""

SURVEY_CTES = """sv AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tucaseid,
         CAST(l_linenumber AS DOUBLE) AS telfs,
         CASE WHEN l_suppkey % 2 = 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS tesex,
         l_quantity AS teage, l_quantity AS t010101, l_extendedprice AS t050101, l_tax AS t180501,
         l_discount AS t020101, CAST(l_partkey AS DOUBLE) AS t170101
  FROM lineitem),
summary AS (
  SELECT CASE WHEN telfs < 3 AND telfs >= 1 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage <= 22 AND teage >= 15 THEN 'young'
              WHEN teage <= 55 AND teage >= 23 THEN 'active' ELSE 'elder' END AS age,
         t010101 / 60 AS primaryNeeds, (t050101 + t180501) / 60 AS work, t020101 / 60 AS other
  FROM sv WHERE telfs <> 5)"""


def _dist(px: str, py: str, cx: str, cy: str) -> str:
    return (f"CAST({px} - {cx} AS DOUBLE) * CAST({px} - {cx} AS DOUBLE) + "
            f"CAST({py} - {cy} AS DOUBLE) * CAST({py} - {cy} AS DOUBLE)")


def kmeans_ctes(steps: int = KMEANS_STEPS, eta: float = ETA) -> list[str]:
    """CTE chain: weighted points, initial centres c0, then ``steps`` unrolled updates.

    Each update assigns points to the nearest centre (lowest index on ties), takes truncated
    integer means, keeps empty clusters, and sums the squared movement; once a movement is
    below eta the ``done`` flag freezes the centres, which equals stopping there.
    """
    ctes = [VEC_CTES, SAMPLE_CTE,
            "pts AS MATERIALIZED (SELECT x, y, count(*) AS n FROM vec GROUP BY x, y)",
            "c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY x, id) - 1 AS INTEGER) AS cluster, "
            "x, y, false AS done FROM smp)"]
    for i in range(1, steps + 1):
        prev = f"c{i - 1}"
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT p.x, p.y, p.n, "
            f"arg_min(c.cluster, row({_dist('p.x', 'p.y', 'c.x', 'c.y')}, c.cluster)) AS cluster "
            f"FROM pts p CROSS JOIN {prev} c GROUP BY p.x, p.y, p.n)")
        ctes.append(
            f"m{i} AS (SELECT cluster, CAST(sum(CAST(x AS BIGINT) * n) // sum(n) AS INTEGER) AS x, "
            f"CAST(sum(CAST(y AS BIGINT) * n) // sum(n) AS INTEGER) AS y FROM a{i} GROUP BY cluster)")
        ctes.append(
            f"u{i} AS MATERIALIZED (SELECT o.cluster, o.x AS ox, o.y AS oy, coalesce(m.x, o.x) AS nx, "
            f"coalesce(m.y, o.y) AS ny, o.done FROM {prev} o LEFT JOIN m{i} m ON o.cluster = m.cluster)")
        ctes.append(f"mv{i} AS (SELECT sum({_dist('nx', 'ny', 'ox', 'oy')}) AS mv FROM u{i})")
        ctes.append(
            f"c{i} AS MATERIALIZED (SELECT u.cluster, CASE WHEN u.done THEN u.ox ELSE u.nx END AS x, "
            f"CASE WHEN u.done THEN u.oy ELSE u.ny END AS y, (u.done OR mv.mv < {eta!r}) AS done "
            f"FROM u{i} u CROSS JOIN mv{i} mv)")
    return ctes


def _round_half_up(expr: str) -> str:
    """Java Math.round(v * 10) / 10: floor plus one when the exact fraction is at least 1/2."""
    x = f"({expr}) * 10"
    return f"(floor({x}) + CASE WHEN {x} - floor({x}) >= 0.5 THEN 1 ELSE 0 END) / 10"


def _with(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _converged(final: str) -> str:
    """A condition that raises in DuckDB unless the unrolled chain has converged at ``final``."""
    return (f"(SELECT CASE WHEN bool_and(done) THEN true "
            f"ELSE error('k-means oracle: raise KMEANS_STEPS, not converged') END FROM {final})")


def _summary_ctes() -> list[str]:
    final = f"c{KMEANS_STEPS}"
    ctes = kmeans_ctes() + [
        f"asg AS (SELECT v.id, v.x, v.y, arg_min(c.cluster, row({_dist('v.x', 'v.y', 'c.x', 'c.y')}, c.cluster)) "
        f"AS cluster FROM vec v CROSS JOIN {final} c GROUP BY v.id, v.x, v.y)",
        "cnt AS (SELECT cluster, x, count(*) AS c FROM asg GROUP BY cluster, x)",
        "dom AS (SELECT cluster, arg_max(x, row(c, -x)) AS lx, max(c) AS mc FROM cnt GROUP BY cluster)",
        "st AS (SELECT cluster, count(*) AS size, quantile_cont(y, 0.5) AS med FROM asg GROUP BY cluster)",
        f"summ AS (SELECT {PRIO_LIST}[lx // {SPREAD} + 1] AS label, "
        "CAST(mc AS DOUBLE) / CAST(size AS DOUBLE) * CAST(100.0 AS DOUBLE) AS percent, "
        "CAST(size AS BIGINT) AS size, CAST(trunc(med) AS INTEGER) AS median FROM dom JOIN st USING (cluster))",
    ]
    return ctes


def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["mention_count"] = (f"SELECT count(*) AS n FROM documents "
                          f"WHERE list_contains(string_split(text, ' '), {_s(COUNT_TERM)})")
    q["mention_postings"] = _with([POSTINGS_CTE], "SELECT term, doc_id FROM postings")
    q["mention_articles"] = _with([POSTINGS_CTE], (
        "SELECT p.term, p.doc_id, d.text FROM postings p JOIN documents d ON d.doc_id = p.doc_id"))
    q["mention_index"] = _with([POSTINGS_CTE], (
        f"SELECT term, doc_id - ((doc_id % {BLOCK}) + {BLOCK}) % {BLOCK} AS block, "
        "string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids "
        "FROM postings GROUP BY term, block"))
    named = "SELECT term, 'doc-' || CAST(doc_id AS VARCHAR) AS id FROM postings"
    bits = f"CASE WHEN (2 * count(*) - 1) // {TEXT_BLOCK} = 0 THEN 0 ELSE length(bin((2 * count(*) - 1) // {TEXT_BLOCK})) END"
    q["mention_index_text"] = _with([POSTINGS_CTE, f"named AS ({named})", (
        f"dir AS (SELECT term, CAST(pow(2, {bits}) AS BIGINT) AS blocks FROM named GROUP BY term)")], (
        "SELECT term, CAST('0x' || substr(md5(id), 1, 15) AS BIGINT) % blocks AS block, "
        "string_agg(id, ',' ORDER BY id) AS doc_ids FROM named JOIN dir USING (term) GROUP BY term, block"))
    q["mention_bitmaps"] = q["mention_postings"]
    q["mention_rank_index"] = _with([POSTINGS_CTE, COUNTS_CTE], "SELECT term, n FROM counts")
    q["mention_rank"] = q["mention_rank_index"]
    q["mention_rank_bitmap"] = q["mention_rank_index"]
    q["mention_rank_full"] = _with([POSTINGS_CTE, COUNTS_CTE], (
        f"SELECT t.term, coalesce(c.n, 0) AS n FROM (SELECT unnest({TERM_LIST}) AS term) t "
        "LEFT JOIN counts c ON t.term = c.term"))
    q["page_record_parse"] = (
        "WITH l AS (SELECT page_id, '<page><title> ' || coalesce(url, '') || '</title><text>' || coalesce(html, '') "
        "|| '  </text></page>' AS v "
        "FROM pages), p AS (SELECT page_id, v, position('</title><text>' IN v) AS p FROM l), "
        "r AS (SELECT page_id, substring(v, 15, p - 15) AS title, "
        "substring(v, p + 14, length(v) - 16 - (p + 13)) AS text FROM p) "
        "SELECT page_id, title, text, CAST(length(text) AS INTEGER) AS n FROM r")
    q["posting_parse"] = (
        "WITH lines AS ("
        "SELECT '1,' || coalesce(CAST(o_orderkey AS VARCHAR), '') || ',,,0,' || coalesce(o_orderpriority, '') "
        "AS value FROM orders UNION ALL "
        "SELECT '2,' || coalesce(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), '') || ',,' "
        f"|| coalesce(CAST(l_orderkey AS VARCHAR), '') || ',' || coalesce(CAST({SCORE} AS VARCHAR), '') FROM lineitem), "
        "f AS (SELECT string_split(value, ',') AS a FROM lines) "
        "SELECT CAST(a[1] AS INTEGER) AS posting_type, CAST(a[2] AS BIGINT) AS id, "
        "CAST(nullif(a[3], '') AS BIGINT) AS accepted_answer, CAST(nullif(a[4], '') AS BIGINT) AS parent_id, "
        "CAST(a[5] AS INTEGER) AS score, nullif(a[6], '') AS tags FROM f")
    q["qa_pairs"] = (
        "SELECT o.o_orderkey AS id, o.o_orderpriority AS tags, l.l_orderkey * 10 + l.l_linenumber AS answer_id, "
        f"{SCORE} AS score FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey")
    q["qa_grouped"] = (
        "SELECT o.o_orderkey AS id, count(*) AS n_answers FROM orders o JOIN lineitem l "
        "ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey")
    q["qa_grouped_pairs"] = (
        f"WITH p AS ({q['qa_pairs']}), r AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY answer_id, score) - 1) "
        f"// {PAIR_BLOCK} AS block FROM p) SELECT id, block, min(tags) AS tags, string_agg(CAST(answer_id AS VARCHAR) || ':' "
        "|| CAST(score AS VARCHAR), ',' ORDER BY answer_id, score) AS answers FROM r GROUP BY id, block")
    q["qa_high_score"] = _with([VEC_CTES], "SELECT id, tags, high_score FROM scored")
    q["tag_index"] = (
        f"SELECT o_orderkey AS id, o_orderpriority AS tags, "
        f"CAST(list_position({PRIO_LIST}, o_orderpriority) - 1 AS INTEGER) AS lang_index FROM orders")
    q["qa_vectors"] = _with([VEC_CTES], "SELECT id, x, y FROM vec")
    q["stratified_sample"] = _with([VEC_CTES, SAMPLE_CTE], "SELECT id, x, y FROM smp")
    q["uniform_sample"] = _with([VEC_CTES], (
        f"SELECT id, x, y FROM vec ORDER BY md5({_s(SEED)} || CAST(id AS VARCHAR)), id "
        f"LIMIT {PER_STRATUM * len(PRIORITIES)}"))
    one = kmeans_ctes(steps=1)
    q["kmeans_assign"] = _with(one, "SELECT x, y, n, cluster FROM a1")
    q["kmeans_step"] = _with(one, "SELECT cluster, nx AS x, ny AS y FROM u1")
    q["kmeans_movement"] = _with(one, "SELECT mv AS movement FROM mv1")
    q["kmeans_fit"] = _with(kmeans_ctes(), f"SELECT cluster, x, y FROM c{KMEANS_STEPS} "
                                           f"WHERE {_converged(f'c{KMEANS_STEPS}')}")
    # an update i ran iff the centres it started from were not frozen yet
    steps = " UNION ALL ".join(
        f"SELECT {i} AS iteration, u.cluster, u.ox AS old_x, u.oy AS old_y, u.nx AS new_x, u.ny AS new_y, "
        f"{_dist('u.nx', 'u.ny', 'u.ox', 'u.oy')} AS distance, mv.mv AS total_distance "
        f"FROM u{i} u CROSS JOIN mv{i} mv WHERE NOT u.done AND {_converged(f'c{KMEANS_STEPS}')}"
        for i in range(1, KMEANS_STEPS + 1))
    q["kmeans_trace"] = _with(kmeans_ctes(), steps)
    q["cluster_summary"] = _with(_summary_ctes(), "SELECT label, percent, size, median FROM summ "
                                                  f"WHERE {_converged(f'c{KMEANS_STEPS}')}")
    # Java's %-5.1f rounds the shortest decimal form of the double half-up; emulate that.
    pct = "CAST(round(CAST(CAST(percent AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DECIMAL(38, 1))"
    q["cluster_report"] = _with(_summary_ctes(), (
        f"SELECT printf('%7d  %-17s (%-5s%%) %7d', median, label, CAST({pct} AS VARCHAR), size) AS line FROM summ "
        f"WHERE {_converged(f'c{KMEANS_STEPS}')}"))
    q["wide_table_read"] = _with([SURVEY_CTES], (
        "SELECT tucaseid, telfs, tesex, teage, t010101, t050101, t180501, t020101, t170101 FROM sv"))
    q["time_usage_summary"] = _with([SURVEY_CTES], "SELECT * FROM summary")
    q["time_usage_typed"] = q["time_usage_summary"]
    q["time_usage_grouped"] = _with([SURVEY_CTES], (
        "SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds, round(avg(work), 1) AS work, "
        "round(avg(other), 1) AS other FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"))
    q["time_usage_grouped_sql"] = q["time_usage_grouped"]
    q["time_usage_grouped_typed"] = _with([SURVEY_CTES], (
        "SELECT working, sex, age, " + ", ".join(
            f"{_round_half_up(f'avg({m})')} AS {m}" for m in ("primaryNeeds", "work", "other"))
        + " FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"))
    return q


ORACLE_SQL: dict[str, str] = _build()
