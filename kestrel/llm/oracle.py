"""DuckDB statements for the operators that SQL can express on whole tables.

Built from the operators' own parameter tables.  The others are compared with brute-force versions
in ``tests/llm``: operators 1 and 6 rest on XXH64, 3 on a parser, 4 on leftmost matches with
offsets, 5 on an iterative tiling, 10 on a trained model, and 9 would list every byte string.
"""

from __future__ import annotations

from kestrel.llm import licenses, quality

SPACES = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


WORDS = (f"w AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), "
         f"'{SPACES}+'), lambda x: x <> '') AS w FROM documents)")


def _distance(doc: str, ref: str, n: int) -> str:
    """Jensen-Shannon distance of two count lists of ``n`` entries."""
    parts = []
    for i in range(1, n + 1):
        p = f"({doc}[{i}] / greatest(list_sum({doc}), 1))"
        q = f"({ref}[{i}] / greatest(list_sum({ref}), 1))"
        for a, b in ((p, q), (q, p)):
            parts.append(f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END / 2")
    return f"sqrt(greatest({' + '.join(parts)}, 0))"


def quality_sql(params: quality.QualityParams = quality.QualityParams(),
                cuts: quality.LengthCuts = quality.LengthCuts()) -> str:
    n = params.window
    classes = [f"length(t) - length(regexp_replace(t, {_text('[' + c + ']')}, '', 'g'))"
               for c in quality.CLASSES.values()]
    classes += ["length(t) - word_chars", "strlen(t) - length(t)"]
    lists = "CASE lang " + " ".join(f"WHEN {_text(k)} THEN {_list(v)}" for k, v in quality.COMMON_WORDS.items()) + " END"
    last, prior = quality.N_CLASSES, params.prior_votes
    fixed = ", ".join(f"({_text(k)}, [{', '.join(map(str, c))}], [{', '.join(map(str, m))}])"
                      for k, (c, m) in quality.REFERENCES.items())

    def shares(counts: str) -> str:
        return (f"list_transform({counts}, lambda x: CAST(floor(x / greatest(list_sum({counts}), 1) * 1000000 + 0.5) "
                "AS BIGINT))")

    def sums(name: str, size: int) -> str:
        return ", ".join(f"sum({name}[{i}])" for i in range(1, size + 1))

    def means(votes: str, name: str, size: int) -> str:
        return ", ".join(f"CAST(floor((coalesce({votes}[{i}], 0) + {prior} * {name}[{i}]) / (coalesce(n, 0) + {prior}) + 0.5) "
                         "AS BIGINT)" for i in range(1, size + 1))

    return f"""WITH {WORDS},
win AS (SELECT doc_id, i, list_slice(w, i, i + {n - 1}) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, sum(least({n}, coalesce(nx - i, {n}))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM dup) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, t, w, len(w) AS n_words, length(regexp_replace(t, '{SPACES}', '', 'g')) AS word_chars,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS l,
      coalesce(rep.n, 0) AS n_repeat_words, {lists} AS own FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
h AS (SELECT *, [{', '.join(classes)}] AS k0, list_transform(own, lambda y: len(list_filter(w, lambda x: x = y))) AS m0 FROM b),
c AS (SELECT *, list_append(k0, strlen(t) - list_sum(k0)) AS k, list_append(m0, n_words - list_sum(m0)) AS m,
      n_words < {params.min_base_words} OR 100 * n_repeat_words > {params.max_repeat_pct} * n_words AS base_failed FROM h),
p(ref, rk, rm) AS (VALUES {fixed}),
a AS (SELECT *, n_words >= {params.min_base_words} AS judged, sqrt(greatest(n_words, 1)) AS root,
      CASE WHEN own IS NULL THEN '' ELSE lang END AS ref FROM c),
g AS (SELECT lang, t, k, m, root, {_distance('k', 'rk', last)} AS kd, {_distance('m', 'rm', quality.N_COMMON)} AS md
      FROM a JOIN p ON p.ref = a.ref WHERE n_words >= {params.min_words} AND NOT base_failed),
v AS (SELECT DISTINCT lang, t, {shares('k')} AS ks, {shares('m')} AS ms FROM g
      WHERE kd <= {cuts.class_spread} / root + {cuts.class_base} AND md <= {cuts.word_base} + {cuts.word_spread} / root),
u AS (SELECT lang, count(*) AS n, [{sums('ks', last)}] AS ks, [{sums('ms', quality.N_COMMON)}] AS ms FROM v GROUP BY lang),
q AS (SELECT ref, [{means('ks', 'rk', last)}] AS rk, [{means('ms', 'rm', quality.N_COMMON)}] AS rm
      FROM p LEFT JOIN u ON u.lang = ref),
r AS (SELECT ref, rk, rm FROM q UNION ALL SELECT '', [{sums('rk', last - 3)}, 0, 0, sum(rk[{last - 2}]) + sum(rk[{last}])], NULL
      FROM q),
o AS (SELECT *, CASE WHEN own IS NULL THEN list_concat(k[1:{last - 3}], [0, 0, k[{last - 2}] + k[{last}]]) ELSE k END AS kk FROM a),
e AS (SELECT lang AS el, [{sums('k', last)}] AS ek, [{sums('m', quality.N_COMMON)}] AS em FROM c
      WHERE own IS NOT NULL AND n_words >= {params.min_words} GROUP BY lang),
j AS (SELECT o.*, rk, rm, ek, em FROM o JOIN r ON r.ref = o.ref LEFT JOIN e ON e.el = o.lang),
s AS (SELECT *, CASE WHEN judged THEN {_distance('kk', 'rk', last)} END AS kd,
      CASE WHEN judged AND rm IS NOT NULL THEN {_distance('m', 'rm', quality.N_COMMON)} END AS md,
      CASE WHEN n_words >= {params.min_words} AND ek IS NOT NULL THEN {_distance('k', 'ek', last)} END AS pd,
      CASE WHEN n_words >= {params.min_common_words} AND em IS NOT NULL
        THEN {_distance('m', 'em', quality.N_COMMON)} END AS qd FROM j)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(k0[{list(quality.CLASSES).index('symbol') + 1}] AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed
    AND NOT coalesce(kd > {cuts.class_spread} / root + CASE WHEN ref = '' THEN {cuts.other_base} ELSE {cuts.class_base} END, false)
    AND NOT coalesce(md > {cuts.word_base} + {cuts.word_spread} / root, false)
    AND NOT coalesce(pd > {params.max_class_distance}, false)
    AND NOT coalesce(qd > {params.max_word_distance}, false) AS kept FROM s"""


def license_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    posted = ", ".join(f"({t}, {_text(w)}, {at})" for t, tpl in enumerate(licenses.LIBRARY) for w, at in tpl.rare)
    library = ", ".join(f"({t}, {_text(tpl.label)}, {tpl.votes}, {len(tpl.rare)})"
                        for t, tpl in enumerate(licenses.LIBRARY))
    keys = ", ".join(f"({t}, {at}, {_list(key)})" for t, tpl in enumerate(licenses.LIBRARY) for at, key in tpl.keys)
    base = len(licenses.BASE)
    return f"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
posted(t, word, pos) AS (VALUES {posted}),
library(t, label, need, total) AS (VALUES {library}),
keys(t, key_at, key) AS (VALUES {keys}),
places AS (SELECT doc_id, t, i - pos AS start, count(*) AS votes FROM p JOIN posted ON x = word GROUP BY ALL),
sure AS (SELECT places.*, label, votes / total AS share FROM places JOIN library USING (t) JOIN d USING (doc_id)
  WHERE votes >= need AND EXISTS (SELECT 1 FROM keys WHERE keys.t = places.t AND start + key_at >= 0
    AND list_slice(w, start + key_at + 1, start + key_at + len(key)) = key))
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words, count(*) FILTER (t < {base}) AS n_base,
  CAST(min(start) FILTER (t < {base}) AS BIGINT) AS first_word,
  CAST(max(start) FILTER (t < {base}) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (t < {base}), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
FROM d LEFT JOIN sure ON sure.doc_id = d.doc_id GROUP BY d.doc_id"""


def substring_sql(n: int = 50) -> str:
    return f"""WITH {WORDS},
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {n - 1}), ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win)
         WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM late),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS s, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) x
         ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.s, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


ORACLE_SQL = {
    "op2_license_scan": license_sql(),
    "op7_quality_rules": quality_sql(),
    "op8_substring_dedup": substring_sql(),
}
