"""DuckDB SQL for the operators that SQL can express. The others are compared with brute-force versions in tests/llm."""

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER)} AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
      UNION ALL SELECT doc_id, chr(1) || array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id, d.doc_id <= coalesce(c.low, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""

_OP2 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
low AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i FROM win JOIN low USING (g) WHERE doc_id > low), range(0, 50) t(k)),
one AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

_SIGNALS = {
    "symbol_share": ("(1000 * n_symbols) // greatest(word_chars, 1)", 10),
    "dup_line_share": ("(1000 * n_dup_lines) // (n_lines + 6)", 40),
    "repeat_share": ("(1000 * n_repeat_words) // greatest(n_words, 1)", 60),
    "word_length": ("least((10 * word_chars) // greatest(n_words, 1), 10000)", 10),
}


_OP4 = f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 3) t(k) GROUP BY doc_id),
s AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines, coalesce(cov.n, 0) AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {', '.join(f'{sql} AS {name}' for name, (sql, _) in _SIGNALS.items())} FROM s),
sig AS ({' UNION ALL '.join(f"SELECT lang, source, '{name}' AS signal, {name} AS unit, {least} AS least_ FROM b WHERE NOT base_failed" for name, (_, least) in _SIGNALS.items())}),
e AS (SELECT lang, signal, any_value(least_) AS least_, quantile_disc(unit, [{', '.join(str((2 * k + 1) / 16) for k in range(8))}]) AS units FROM sig GROUP BY lang, signal),
p AS (SELECT lang, source, signal, unit, least_ FROM sig UNION ALL SELECT g.lang, g.source, g.signal, unnest(e.units), e.least_ FROM (SELECT DISTINCT lang, source, signal FROM sig) g JOIN e ON g.lang IS NOT DISTINCT FROM e.lang AND g.signal = e.signal),
f AS (SELECT lang, source, signal, quantile_disc(unit, 0.75) + 6 * greatest(quantile_disc(unit, 0.75) - quantile_disc(unit, 0.25), any_value(least_)) AS fence FROM p GROUP BY lang, source, signal),
x AS (SELECT lang, source, {', '.join(f"max(fence) FILTER (signal = '{name}') AS max_{name}" for name in _SIGNALS)} FROM f GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(f'coalesce({name} <= max_{name}, true)' for name in _SIGNALS)} AS kept
FROM b LEFT JOIN x ON b.lang IS NOT DISTINCT FROM x.lang AND b.source IS NOT DISTINCT FROM x.source"""

_SAID = "'</s>[INST] ok [/INST]'"
_CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<bos>", "<eos>", "<pad>", "<unk>", "<start_of_turn>", "<end_of_turn>")


def _escaped_length(text: str) -> str:
    """Every backslash and every control string makes the escaped text longer by one character."""
    more = " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ("\\", *_CONTROL))
    return f"length({text}) + {more}"


_OP6 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', {_SAID} UNION ALL SELECT -1, 1, 'assistant', {_SAID}),
t AS (SELECT *, sum(23 + {_escaped_length('role')} + {_escaped_length('text')}) OVER w AS upto, lead(turn) OVER w IS NULL AS is_last FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id"""

SQL: dict[str, str] = {"op1_minhash": _OP1, "op2_substring": _OP2, "op4_quality": _OP4, "op6_chat": _OP6}
