"""SQL twins of the fill-in-the-middle, quality and conversation queries."""

from __future__ import annotations

INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u FROM d),
h AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
  ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM h),
p AS (SELECT *, coalesce(array_to_string(u[1:lo], ''), '') AS pre, coalesce(array_to_string(u[lo + 1:hi], ''), '') AS mid,
  coalesce(array_to_string(u[hi + 1:], ''), '') AS suf,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""

# The rounds of expectation-maximisation run over the patterns of votes as one list.
_RIGHT = """list_transform(range(1, 10), lambda j: greatest(0.1, (list_sum(list_transform(range(1, len(seen) + 1), lambda i:
      CASE WHEN seen[i].v[j] = {vote} THEN seen[i].n * {share} ELSE 0.0 END)) + {damped})
    / (list_sum(list_transform(range(1, len(seen) + 1), lambda i: CASE WHEN seen[i].v[j] >= 0 THEN seen[i].n * {share} ELSE 0.0 END)) + 10.0)))"""
_ODDS = """ln(prior / (1 - prior)) + list_sum(list_transform(range(1, 10), lambda j: CASE {v}[j] WHEN 1 THEN ln(g[j] / (1 - b[j]))
    WHEN 0 THEN ln((1 - g[j]) / b[j]) ELSE 0.0 END))"""

QUALITY = r"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM base),
placed AS (SELECT rid, i, row(w[i], w[i + 1], w[i + 2]) AS x FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
again AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, x) AS c FROM placed) WHERE c > 1),
inside AS (SELECT rid, count(DISTINCT i + d) AS n FROM again, (SELECT unnest([0, 1, 2]) AS d) GROUP BY rid),
q AS (
  SELECT s.rid, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(i.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '[.!?][ \t\n\x0B\f\r]*$'))) AS n_ended_lines, len(list_distinct(w)) AS n_distinct,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '[\p{L}\p{N}]'))) AS n_lone,
    length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) + length(regexp_replace(t, '[^A-Za-z\x00-\x08\x0E-\x1F\x7F]', '', 'g')) AS n_letters
  FROM split s LEFT JOIN inside i USING (rid)),
cast_ AS (
  SELECT *, [
    CASE WHEN n_words < 20 THEN 0 WHEN n_words >= 100 THEN 1 ELSE -1 END,
    CASE WHEN 10 * n_symbols >= n_words THEN 0 WHEN 50 * n_symbols <= n_words THEN 1 ELSE -1 END,
    CASE WHEN 10 * n_dup_lines >= 3 * n_lines THEN 0 WHEN 10 * n_dup_lines <= n_lines THEN 1 ELSE -1 END,
    CASE WHEN 10 * n_repeat_words >= 3 * n_words THEN 0 WHEN 10 * n_repeat_words <= n_words THEN 1 ELSE -1 END,
    CASE WHEN 10 * n_distinct < 2 * n_words THEN 0 WHEN 10 * n_distinct >= 4 * n_words THEN 1 ELSE -1 END,
    CASE WHEN 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words THEN 0 WHEN word_chars >= 3 * n_words AND word_chars <= 8 * n_words THEN 1 ELSE -1 END,
    CASE WHEN 100 * n_letters < 75 * word_chars THEN 0 WHEN 100 * n_letters >= 85 * word_chars THEN 1 ELSE -1 END,
    CASE WHEN 5 * n_lone >= n_words THEN 0 WHEN 20 * n_lone <= n_words THEN 1 ELSE -1 END,
    CASE WHEN 2 * n_ended_lines < n_lines THEN 0 WHEN 10 * n_ended_lines >= 8 * n_lines THEN 1 ELSE -1 END] AS v FROM q),
seen AS (SELECT list({'v': v, 'n': n} ORDER BY v) AS seen FROM (SELECT v, count(*)::DOUBLE AS n FROM cast_
  WHERE NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) GROUP BY v)),
em(k, prior, g, b) AS (
  SELECT 0, 0.8::DOUBLE, list_transform(range(9), lambda x: 0.95::DOUBLE), list_transform(range(9), lambda x: 0.5::DOUBLE)
  UNION ALL
  SELECT k + 1, (list_sum(list_transform(range(1, len(seen) + 1), lambda i: seen[i].n * p[i])) + 8.0) / (list_sum(list_transform(seen, lambda r: r.n)) + 10.0),
    """ + _RIGHT.format(vote=1, share="p[i]", damped="10 * 0.95::DOUBLE") + ",\n    " + _RIGHT.format(vote=0, share="(1 - p[i])", damped="10 * 0.5::DOUBLE") + """
  FROM (SELECT k, seen, list_transform(seen, lambda r: 1 / (1 + exp(-(""" + _ODDS.format(v="r.v") + """)))) AS p FROM em, seen WHERE k < 30))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p >= 0.5 AS kept FROM (
  SELECT c.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1 / (1 + exp(-(""" + _ODDS.format(v="v") + """))) AS p
  FROM cast_ c, em WHERE k = 30)
"""


def _add(s: str, cost: int | str, letters: str) -> str:
    """A state's best as text, 12 digits of cost and the audit, so that the least text is the best."""
    return f"lpad((left({s}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({s}, 13) || '{letters}'"


def _step() -> str:
    """The four states after one more row, from s0 to s3 and the row's kind, fault and extra cost."""
    i0, i1 = "s0", "s1"
    i2 = f"least(s2, {_add('s0', 3, 'I')}, {_add('s1', 3, 'I')}, {_add('s3', 3, 'I')})"
    i3 = f"least(s3, {_add('s2', 3, 'I')}, {_add('s0', 6, 'II')}, {_add('s1', 6, 'II')})"
    free = "fault IN (0, 3)"
    keep = lambda s, role: f"CASE WHEN {free} AND kind = '{role}' THEN {_add(s, 'extra', 'K')} END"
    role = lambda s: f"CASE WHEN {free} THEN {_add(s, '3 + extra', 'R')} END"
    return f"""SELECT conv_id, i, kind, fault, extra, {_add('i0', 4, 'D')} AS s0,
  least({_add('i1', 4, 'D')}, {keep('i0', 's')}) AS s1,
  least({_add('i2', 4, 'D')}, {keep('i0', 'u')}, {keep('i1', 'u')}, {keep('i3', 'u')}, {role('i0')}, {role('i1')}, {role('i3')}) AS s2,
  least({_add('i3', 4, 'D')}, {keep('i2', 'a')}, {role('i2')}) AS s3
FROM (SELECT f.conv_id, f.i, f.kind, f.fault, CASE WHEN f.fault = 3 THEN 3 ELSE 0 END AS extra, {i0} AS i0, {i1} AS i1, {i2} AS i2, {i3} AS i3
  FROM dp JOIN symbols f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1)"""


REPAIR = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
summed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_concat([4294967295],
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, y: xor(a >> 8, tab[(xor(a, y) & 255) + 1])), 4294967295) % 20 AS how FROM conversations, tab),
changed AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM summed WHERE how <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g') AS bare,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS kind FROM changed),
symbols AS (
  SELECT conv_id, turn, i, kind, role, text, CASE WHEN bare = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    coalesce(lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind NOT IN ('su', 'ua', 'au'), false)::BIGINT AS bad FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, sum(bad)::BIGINT AS illegal, max(i) AS n FROM symbols GROUP BY conv_id),
dp(conv_id, i, kind, fault, extra, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '', 0, 0, '000000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM symbols
  UNION ALL
  """ + _step() + r"""),
best AS (
  SELECT d.conv_id, least(s0, s3, """ + ", ".join((_add("s2", 3, "I"), _add("s0", 6, "II"), _add("s1", 6, "II"))) + r""") AS s
  FROM dp d JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.n = d.i),
audits AS (SELECT conv_id, left(s, 12)::BIGINT AS cost, substr(s, 13) AS audit FROM best),
written(conv_id, audit, p, i, state, line) AS (
  SELECT conv_id, audit, 0, 0::BIGINT, '0', NULL::VARCHAR FROM audits
  UNION ALL
  SELECT conv_id, audit, p + 1, i2, CASE WHEN e = 'D' THEN state ELSE left(role2, 1) END,
    CASE e WHEN 'D' THEN NULL WHEN 'I' THEN role2 || ':' ELSE role2 || ':' || text END
  FROM (SELECT w.*, substr(w.audit, w.p + 1, 1) AS e, w.i + CASE WHEN substr(w.audit, w.p + 1, 1) = 'I' THEN 0 ELSE 1 END AS i2, f.text,
      CASE WHEN substr(w.audit, w.p + 1, 1) = 'K' THEN f.role WHEN w.state = 'u' THEN 'assistant' ELSE 'user' END AS role2
    FROM written w LEFT JOIN symbols f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 WHERE w.p < length(w.audit))),
texts AS (SELECT conv_id, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (line IS NOT NULL), '') AS t FROM written GROUP BY conv_id)
SELECT c.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated,
  coalesce(k.illegal, 0)::BIGINT AS illegal, coalesce(a.cost, 0) AS cost, coalesce(a.audit, '') AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
