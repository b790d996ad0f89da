"""The queries of this subpackage in SQL, where SQL can say the same over whole tables: near duplicates by a join of all shingles,
tokens by merging pairs step by step, and what every packing and mixture must keep."""

from __future__ import annotations

from grainmill.llm.bpe import TOKENIZER_DIR
from grainmill.llm.labels import LANG_NAMES, PLACEHOLDERS
from grainmill.plans.oracle import WS, q, strip, tokens, words

RANKS = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
MISSING = f"({', '.join(map(q, PLACEHOLDERS))})"


def label(c: str, missing: str = "unknown") -> str:
    x = f"lower({strip(c)})"
    return f"CASE WHEN {c} IS NULL OR {x} IN {MISSING} THEN '{missing}' ELSE {x} END"


def lang(c: str) -> str:
    x, base = f"lower({strip(c)})", f"regexp_extract(lower({strip(c)}), '^([^-_]*)', 1)"
    named = " ".join(f"WHEN {x} IN ({', '.join(map(q, v))}) OR {base} IN ({', '.join(map(q, v))}) THEN '{k}'" for k, v in LANG_NAMES.items())
    return f"CASE WHEN {c} IS NULL OR {x} IN {MISSING} THEN 'und' {named} ELSE {base} END"


SIMILAR = f"""w AS (SELECT ord, {words("lower(nfc_normalize(text))")} AS ws FROM corpus WHERE {strip('text')} <> ''),
g AS (SELECT ord, CASE WHEN len(ws) <= 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS g FROM w),
s AS MATERIALIZED (SELECT ord, len(g) AS n, unnest(g) AS x FROM g),
pairs AS MATERIALIZED (SELECT a.ord AS ord_a, b.ord AS ord_b FROM s a JOIN s b ON a.x = b.x AND a.ord < b.ord GROUP BY a.ord, b.ord, a.n, b.n HAVING count(*) >= 0.7 * (a.n + b.n - count(*)))"""
GROUPS = f"""{SIMILAR}, both_ways AS (SELECT ord_a AS u, ord_b AS v FROM pairs UNION ALL SELECT ord_b, ord_a FROM pairs),
reach AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
least AS (SELECT u, least(u, min(v)) AS label FROM reach GROUP BY u), degree AS (SELECT u, count(*) AS n FROM both_ways GROUP BY u)"""


def counted(src: str, key: str) -> str:
    return f"{tokens(src, key, RANKS)}, n AS (SELECT {key}, sum(len(ids))::BIGINT AS n_tokens FROM pc JOIN ids USING (piece) GROUP BY {key})"


SLICES = f"""{counted('corpus', 'ord')}, c AS (SELECT {label('source')} AS source, {lang('lang')} AS lang, {label('topic')} AS topic, text, coalesce(n_tokens, 0) AS n_tokens FROM corpus LEFT JOIN n USING (ord))"""
LEVELS = [("source", "lang", "topic"), ("source", "lang"), ("source",), ("lang",), ("topic",), ()]


def budget() -> str:
    parts = []
    for own in LEVELS:
        cols = ", ".join(c if c in own else f"NULL::VARCHAR AS {c}" for c in LEVELS[0])
        parts.append(f"SELECT '{'+'.join(own) or 'total'}' AS level, {cols}, count(*) AS n_docs, count(CASE WHEN {strip('text')} <> '' THEN 1 END) AS n_usable, coalesce(sum(length(text)), 0)::BIGINT AS n_chars, coalesce(sum(n_tokens), 0)::BIGINT AS n_tokens FROM c {'GROUP BY ' + ', '.join(own) if own else ''}")
    return f"WITH RECURSIVE {SLICES} " + " UNION ALL ".join(parts)


#: What any packing keeps: every length once, cut only where it is larger than the largest container, nothing overfull.
PACKED = f"""{counted('corpus', 'ord')}, l AS (SELECT coalesce(length(text), 0)::BIGINT AS chars, coalesce(n_tokens, 0) AS tokens FROM corpus LEFT JOIN n USING (ord)),
plans AS (SELECT 'spec ' || spec_id AS plan, unit, max_size AS top FROM pack_specs WHERE unit IS NOT NULL AND max_size > 0 UNION ALL SELECT 'joint ' || unit, unit, max(max_size) FROM pack_specs WHERE unit IS NOT NULL AND max_size > 0 GROUP BY unit),
x AS (SELECT plan, top, CASE unit WHEN 'chars' THEN chars ELSE tokens END AS n FROM plans, l)"""
MIXED = f"""{counted('documents', 'doc_id')}, t AS (SELECT plan_id, {label('source')} AS source, sum(target_share) AS w, max(max_repeats) AS cap FROM mix_targets WHERE target_share > 0 AND max_repeats > 0 GROUP BY ALL),
d AS (SELECT {label('source')} AS source, sum(n_tokens)::BIGINT AS total FROM documents JOIN n USING (doc_id) WHERE n_tokens > 0 GROUP BY 1),
live AS (SELECT plan_id, t.source, w, cap, total FROM t JOIN d ON d.source = t.source AND t.source <> 'unknown')"""

SQL = {
    "p2_found": f"WITH {SIMILAR} SELECT ord_a, ord_b FROM pairs",
    "p2_groups": f"WITH RECURSIVE {GROUPS} SELECT w.ord, coalesce(label, w.ord) AS group_id, coalesce(n, 0) AS n_links FROM w LEFT JOIN least ON least.u = w.ord LEFT JOIN degree ON degree.u = w.ord",
    "p4_token_budget": budget(),
    "p4_document_tokens": f"WITH RECURSIVE {counted('corpus', 'ord')} SELECT ord, {label('source')} AS source, {lang('lang')} AS lang, {label('topic')} AS topic, coalesce(n_tokens, 0) AS n_tokens FROM corpus LEFT JOIN n USING (ord)",
    "p5_kept": f"WITH RECURSIVE {PACKED} SELECT plan, sum(CASE WHEN n > 0 THEN (n - 1) // top + 1 ELSE 1 END)::BIGINT AS n_parts, sum(n)::BIGINT AS total, 0::BIGINT AS n_overfull, 0::BIGINT AS n_torn FROM x GROUP BY plan",
    "p7_ids": f"WITH RECURSIVE {tokens('documents', 'doc_id', RANKS)}, d AS (SELECT doc_id, flatten(list(ids.ids ORDER BY pos)) AS ids FROM pc JOIN ids USING (piece) GROUP BY doc_id) SELECT doc_id, coalesce(d.ids, []::INTEGER[]) AS ids FROM documents LEFT JOIN d USING (doc_id)",
    "p8_kept": f"WITH RECURSIVE {MIXED} SELECT plan_id, source, round(w / sum(w) OVER (PARTITION BY plan_id), 6) AS due_share, TRUE AS on_target, TRUE AS within_cap FROM live",
}
