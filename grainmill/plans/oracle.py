"""The queries in SQL, where SQL can say the same over whole tables."""

from __future__ import annotations

from grainmill.operators.dedup import BANDS, PRIME, ROWS
from grainmill.operators.pack import END_OF_TEXT, RANKS
from grainmill.operators.qa import PROMPT_DE, PROMPT_EN
from grainmill.operators.sft import CONTINUE, SUMMARIZE, TITLE_QA

SEQ_LEN = 2048
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm(x: str) -> str:
    return strip(f"regexp_replace(lower(nfc_normalize({x})), '{WS}+', ' ', 'g')")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def choice(n: str, *parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8))::BIGINT % ({n}))"


def pick(templates: list[str], salt: str) -> str:
    return f"list_value({', '.join(map(q, templates))})[{choice(str(len(templates)), q('42'), 'ord::VARCHAR', q(salt))} + 1]"


def truncate(x: str, most: int) -> str:
    cut = f"substr({x}, 1, {most})"
    last = "greatest(" + ", ".join(f"CASE WHEN instr({cut}, '{m}') > 0 THEN length({cut}) - instr(reverse({cut}), '{m}') ELSE -1 END" for m in ".!?") + ")"
    return f"CASE WHEN length({x}) <= {most} THEN {x} WHEN {last} > {most // 2} THEN substr({cut}, 1, {last} + 1) ELSE {cut} END"


PARAGRAPH = f"list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: {strip('p')}), lambda p: length(p) >= 80)[1]"
MARKED = f"""n AS (SELECT ord, text, CASE WHEN length({strip('text')}) >= 200 THEN sha256({norm(strip('text'))}) END AS sha FROM corpus),
marked AS (SELECT ord, text, CASE WHEN sha IS NULL THEN 'too_short' WHEN ord = min(ord) OVER (PARTITION BY sha) THEN 'kept' ELSE 'duplicate' END AS status FROM n)"""
GRAMS = f"""w AS (SELECT ord, t, {words('t')} AS ws FROM src),
g AS (SELECT ord, CASE WHEN len(ws) <= 5 THEN [t] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS g FROM w WHERE t IS NOT NULL)"""
BANDKEYS = f"""h AS (SELECT ord, unnest(list_transform(g, lambda s: ('0x' || substr(md5(s), 1, 15))::BIGINT % {PRIME})) AS h FROM g),
p AS (SELECT i, (i * 1103515245 + 12345) % {PRIME - 1} + 1 AS a, (i * 22695477 + 1) % {PRIME} AS b FROM range(1, {BANDS * ROWS + 1}) r(i)),
m AS (SELECT ord, i, min((a * h + b) % {PRIME}) AS m FROM h, p GROUP BY ord, i),
k AS (SELECT ord, (i - 1) // {ROWS} AS band, md5(string_agg(m::VARCHAR, ',' ORDER BY i)) AS key FROM m GROUP BY ord, (i - 1) // {ROWS})"""
STREAM = f"""w AS (SELECT ord, list_append(list_transform({words("coalesce(text, '')")}, lambda w: ('0x' || substr(md5(w), 1, 7))::BIGINT), 0) AS ids FROM corpus),
o AS (SELECT ord, ids, (sum(len(ids)) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len(ids))::BIGINT AS start FROM w),
t AS (SELECT start + i - 1 AS pos, ids[i] AS id FROM (SELECT start, ids, unnest(range(1, len(ids) + 1)) AS i FROM o)),
c AS (SELECT pos // {SEQ_LEN} AS chunk, list(id ORDER BY pos) AS ids FROM t GROUP BY 1),
kept AS (SELECT chunk, len(ids) AS n, list_concat(ids, list_transform(range({SEQ_LEN} - len(ids)), lambda x: 0::BIGINT)) AS ids FROM c WHERE len(ids) > {SEQ_LEN // 2})"""
PAGES = """j AS (SELECT path, string_agg(page_text, chr(10) || chr(10) ORDER BY page, page_text) AS text FROM (SELECT DISTINCT path, page, page_text FROM pdf_pages WHERE """ + strip("page_text") + """ <> '') GROUP BY path)"""


def pdf_clean(x: str) -> str:
    y = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    blank = WS.replace(r"\s", r" \t\f\r")
    y = f"regexp_replace({y}, '{blank}{{2,}}', ' ', 'g')"
    ends = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
    return strip(f"array_to_string(list_filter(regexp_split_to_array({y}, '{ends}'), lambda l: NOT regexp_full_match(l, '{WS}*[0-9ivxlcIVXLC]+{WS}*')), chr(10))")


TITLE_ROW = f"""SELECT ord, replace({pick(TITLE_QA, 'title')}, '{{title}}', title) AS instruction, '' AS input, {truncate('p', 1000)} AS output, coalesce(source, '') AS source, coalesce(lang, '') AS lang
FROM (SELECT ord, {strip('title')} AS title, {PARAGRAPH} AS p, source, lang FROM corpus) WHERE length(title) >= 3 AND p IS NOT NULL"""
SUMMARY_ROW = f"""SELECT ord, {pick(SUMMARIZE, 'summary')} AS instruction, body AS input, p AS output, coalesce(source, '') AS source, coalesce(lang, '') AS lang
FROM (SELECT ord, {truncate('text', 4000)} AS body, {PARAGRAPH} AS p, source, lang FROM corpus) WHERE length(body) > length(p) + 100"""
CONTINUE_ROW = f"""SELECT ord, {pick(CONTINUE, 'continue')} AS instruction, array_to_string(ws[1:cut], ' ') AS input, array_to_string(ws[cut+1:cut+150], ' ') AS output, coalesce(source, '') AS source, coalesce(lang, '') AS lang
FROM (SELECT *, len(ws) // 5 + {choice('len(ws) // 3 - len(ws) // 5 + 1', q('42'), 'ord::VARCHAR', q('split'))} AS cut FROM (SELECT ord, {words('text')} AS ws, source, lang FROM corpus) WHERE len(ws) >= 120)"""
RANK = ", ".join(f"{{'h': {choice('4294967296', q('42'), 'ord::VARCHAR', q(f'rank{i}'))}, 'k': '{k}'}}" for i, k in enumerate(("summary", "title", "continue")))
KINDS = f"""r AS (SELECT ord, list_transform(list_sort([{RANK}]), lambda x: x.k) AS ks FROM corpus),
made AS (SELECT ord, 'summary' AS kind, instruction, input, output, source, lang FROM ({SUMMARY_ROW}) UNION ALL SELECT ord, 'title', instruction, input, output, source, lang FROM ({TITLE_ROW}) UNION ALL SELECT ord, 'continue', instruction, input, output, source, lang FROM ({CONTINUE_ROW}))"""
STEM = "regexp_replace(regexp_extract(file, '([^/]*)$', 1), '^(.+)\\.[^.]*$', '\\1')"

#: The greedy rule as a walk over the documents with an earlier partner, one by one in order.
GREEDY = f"""{MARKED}, src AS (SELECT ord, {norm('text')} AS t FROM marked WHERE status = 'kept'), {GRAMS}, {BANDKEYS},
e AS (SELECT DISTINCT a.ord AS i, b.ord AS j FROM k a JOIN k b USING (band, key) WHERE a.ord < b.ord),
cand AS (SELECT j, row_number() OVER (ORDER BY j) AS r, list(i) AS before FROM e GROUP BY j),
walk AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS gone UNION ALL SELECT w.r + 1, CASE WHEN len(list_filter(c.before, lambda x: NOT list_contains(w.gone, x))) > 0 THEN list_append(w.gone, c.j) ELSE w.gone END FROM walk w JOIN cand c ON c.r = w.r + 1),
near AS (SELECT unnest(gone) AS ord FROM (SELECT gone FROM walk ORDER BY r DESC LIMIT 1)),
final AS (SELECT marked.ord, marked.text, CASE WHEN near.ord IS NOT NULL THEN 'near' WHEN marked.status = 'duplicate' THEN 'exact' ELSE marked.status END AS status FROM marked LEFT JOIN near USING (ord))"""


def markdown(x: str) -> str:
    """The rules in order; a back-reference to one to three marks is spelled out, and what may not begin with the marks too."""

    def marks(c: str) -> str:
        return f"{c}{{3}}((?:[^{c}]|{c}[^{c}]|{c}{c}[^{c}])(?s:.*?)){c}{{3}}|{c}{{2}}((?:[^{c}]|{c}[^{c}])(?s:.*?)){c}{{2}}|{c}([^{c}]+?){c}"

    # fixed values: the patterns and their order
    rules = [
        (r"```(?s:.*?)```", ""), (r"~~~(?s:.*?)~~~", ""), (r"`[^`\n]+`", ""), (r"!\[.*?\]\(.*?\)", ""), (r"\[([^\]]+)\]\([^\)]+\)", r"\1"), (r"<[^>]+>", ""), (rf"(?m)^#{{1,6}}{WS}+", ""), (rf"(?m)^[=]{{3,}}{WS}*$", ""), (rf"(?m)^[-]{{3,}}{WS}*$", ""),
        (marks(r"[*]").replace("[^[*]]", "[^*]"), r"\1\2\3"), (marks("_"), r"\1\2\3"), (rf"(?m)^[*_]{{3,}}{WS}*$", ""), (rf"(?m)^>{WS}?", ""), (r"(?m)^\.\. [\pL\pN_][\pL\pN_-]*::", ""), (r"\n{3,}", "\n\n"),
    ]
    for pattern, to in rules:
        x = f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"
    return strip(x)


#: Numbers of questions that are told apart where a pattern cannot compare two numbers.
NUMBERS = range(31)


def _pair(n: int) -> str:
    return rf"[FQ]{n}:{WS}*(.+?){WS}*\n[AB]{n}:{WS}*(.+?)"


def _first(k: int) -> str:
    each = " ".join(f"WHEN '{n}' THEN regexp_extract(whole, {q(rf'(?is)^{_pair(n)}(?:\n[FQ][0-9]+:|\z)')}, {k})" for n in NUMBERS)
    return strip(f"CASE regexp_extract(whole, '(?i)^[FQ]([0-9]+):', 1) {each} END")


ANY_PAIR = rf"(?is)(?:{'|'.join(_pair(n).replace('(.+?)', '(?:.+?)') for n in NUMBERS)})(?:\n[FQ][0-9]+:|\z)"
REST = "substr(rest, instr(rest, whole) + length(whole) - length(regexp_extract(whole, '(?i)\n[FQ][0-9]+:$', 0)))"
PARSED = f"""t AS (SELECT raw_id, source, lang, rest, regexp_extract(rest, {q(ANY_PAIR)}, 0) AS whole FROM (SELECT raw_id, source, lang, 'Q1:' || raw AS rest FROM qa_raw WHERE raw IS NOT NULL)
UNION ALL SELECT raw_id, source, lang, {REST}, regexp_extract({REST}, {q(ANY_PAIR)}, 0) FROM t WHERE whole <> ''),
pairs AS (SELECT raw_id, {_first(1)} AS instruction, '' AS input, {_first(2)} AS output, coalesce(source, '') AS source, coalesce(lang, '') AS lang FROM t WHERE whole <> ''),
parsed AS (SELECT * FROM pairs WHERE length(instruction) >= 10 AND length(output) >= 10)"""
#: Stands between pieces where a blank goes to the next word; no text holds it.
BAR = r"\x{f0000}"
SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NO_SPACE = SPACE.replace("[", "[^", 1)
#: Fixed value: how a public tokenizer cuts texts into pieces.
SPLIT = rf"'(?:s|t|re|ve|m|ll|d)| ?\pL+| ?\pN+| ?{NO_SPACE[:-1]}\pL\pN{BAR}]+|{SPACE}+"


def tokens(src: str, key: str, ranks: str) -> str:
    """CTEs that end in ``ids (piece, ids)`` and ``pc (key, piece, pos)``: byte pair encoding of ``src``'s texts by a file of ranks.
    A step merges the pair of least rank in each piece, the first one where it is met twice."""
    return f"""v AS MATERIALIZED (SELECT hex(from_base64(t)) AS h, r FROM read_csv('{ranks}', delim=' ', header=false, quote='', escape='', columns={{'t': 'VARCHAR', 'r': 'INTEGER'}})),
pl AS (SELECT {key}, regexp_extract_all(regexp_replace(text, {q(f'({SPACE}+)({SPACE}{NO_SPACE})')}, '\\1' || chr(983040) || '\\2', 'g'), {q(SPLIT)}) AS p FROM {src} WHERE text IS NOT NULL),
pc AS MATERIALIZED (SELECT {key}, unnest(p) AS piece, generate_subscripts(p, 1) AS pos FROM pl),
st AS (SELECT piece, 0 AS step, list_transform(range(0, length(hex(encode(piece))) // 2), lambda i: substr(hex(encode(piece)), 2 * i + 1, 2)) AS syms FROM (SELECT DISTINCT piece FROM pc)
UNION ALL SELECT piece, step + 1, list_concat(list_append(syms[:i - 1], syms[i] || syms[i + 1]), syms[i + 2:]) FROM (SELECT piece, step, any_value(syms) AS syms, arg_min(i, r * 1000000::BIGINT + i) AS i FROM (SELECT piece, step, syms, unnest(range(1, len(syms))) AS i FROM st) JOIN v ON v.h = syms[i] || syms[i + 1] GROUP BY piece, step)),
ids AS (SELECT piece, list(r ORDER BY i) AS ids FROM (SELECT piece, unnest(syms) AS s, generate_subscripts(syms, 1) AS i FROM (SELECT piece, arg_max(syms, step) AS syms FROM st GROUP BY piece)) JOIN v ON v.h = s GROUP BY piece)"""


RANK_STREAM = f"""{tokens('corpus', 'ord', RANKS)}, d AS (SELECT ord, flatten(list(ids.ids ORDER BY pos)) AS ids FROM pc JOIN ids USING (piece) GROUP BY ord),
w AS (SELECT ord, list_append(coalesce(d.ids, []::INTEGER[]), {END_OF_TEXT}) AS ids FROM corpus LEFT JOIN d USING (ord)), {STREAM[STREAM.index('o AS (') :].replace('0::BIGINT', f'{END_OF_TEXT}')}"""
LABEL = f"lower({strip('source')})"
JSON = "'{' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || to_json({c}) END" for c in ("id", "title", "url", "text", "source", "lang", "file")) + "], lambda x: x IS NOT NULL), ',') || '}'"

SQL = {
    "corpus_min_length": f"SELECT ord, length(text) AS n_chars FROM corpus WHERE length({strip('text')}) >= 200",
    "wiki_min_length": f"SELECT ord, length({strip('text')}) AS n_chars, md5({strip('text')}) AS digest FROM corpus WHERE source = 'wikipedia' AND length({strip('text')}) >= 200",
    "pdf_min_length": f"SELECT pdf_no, length(t) AS n_chars FROM (SELECT pdf_no, {pdf_clean('text')} AS t FROM pdfs) WHERE length(t) >= 500",
    "qa_min_chars": "SELECT ord FROM corpus WHERE length(text) >= 300",
    "not_blank": f"SELECT ord FROM corpus WHERE {strip('text')} <> ''",
    "normalize_sha256": f"SELECT ord, sha256({norm(strip('text'))}) AS sha FROM corpus",
    "exact_dedup": f"WITH {MARKED} SELECT ord FROM marked WHERE status = 'kept'",
    "dedup_status_counts": f"WITH {MARKED} SELECT status, count(*) AS n FROM marked GROUP BY status",
    "word_shingles": f"WITH src AS (SELECT ord, {norm('text')} AS t FROM corpus), {GRAMS} SELECT corpus.ord, len(g.g)::BIGINT AS n, list_min(g.g) AS least FROM corpus LEFT JOIN g USING (ord)",
    "minhash_signature": f"WITH src AS (SELECT ord, {norm('text')} AS t FROM corpus), {GRAMS}, {BANDKEYS}, s AS (SELECT ord, md5(string_agg(key, ',' ORDER BY band)) AS digest FROM k GROUP BY ord) SELECT corpus.ord, s.digest FROM corpus LEFT JOIN s USING (ord)",
    "lsh_buckets": f"WITH {MARKED}, src AS (SELECT ord, {norm('text')} AS t FROM marked WHERE status = 'kept'), {GRAMS}, {BANDKEYS} SELECT band, key, count(*) AS n_docs, min(ord) AS first_ord FROM k GROUP BY band, key HAVING count(*) > 1",
    "first_paragraph": f"SELECT ord, p AS paragraph FROM (SELECT ord, {PARAGRAPH} AS p FROM corpus) WHERE p IS NOT NULL",
    "truncate_at_sentence": f"SELECT ord, {truncate('text', 400)} AS text FROM corpus",
    "whitespace_words": f"SELECT ord, len(ws)::BIGINT AS n, md5(array_to_string(ws, ' ')) AS digest FROM (SELECT ord, {words('text')} AS ws FROM corpus WHERE text IS NOT NULL)",
    "excerpts": f"SELECT ord, md5({strip('substr(text, 1, 2000)')}) AS digest FROM corpus",
    "stem_titles": f"SELECT pdf_no, {STEM} AS stem, translate({STEM}, '_-', '  ') AS title FROM pdfs",
    "markdown_records": f"SELECT ord, file AS id, translate({STEM}, '_-', '  ') AS title, 'markdown' AS source, file FROM corpus WHERE source = 'markdown' AND file IS NOT NULL",
    "strip_tags": "SELECT doc_id, md5(regexp_replace(text, '<[^>]+>', '', 'g')) AS digest FROM documents WHERE text IS NOT NULL",
    "join_pages": f"WITH {PAGES} SELECT path, md5(text) AS digest FROM j",
    "pdf_clean": f"WITH {PAGES} SELECT path, md5({pdf_clean('text')}) AS digest FROM j",
    "page_number_lines": f"SELECT pdf_no, count(*) AS n FROM (SELECT pdf_no, unnest(string_split(text, chr(10))) AS line FROM pdfs) WHERE regexp_full_match(line, '{WS}*[0-9ivxlcIVXLC]+{WS}*') GROUP BY pdf_no",
    "title_qa": TITLE_ROW,
    "summary_examples": SUMMARY_ROW,
    "continue_examples": CONTINUE_ROW,
    "sft_examples": f"WITH {KINDS} SELECT made.* FROM made JOIN r USING (ord) WHERE kind = ks[1]",
    "sft_kinds": f"WITH {KINDS} SELECT kind, count(*) AS n FROM made JOIN r USING (ord) WHERE kind = ks[1] OR kind = ks[2] GROUP BY kind",
    "max_docs_limit": "SELECT ord FROM corpus WHERE text IS NOT NULL ORDER BY ord LIMIT 500",
    "max_docs_after_filter": "SELECT ord FROM corpus WHERE length(text) >= 300 ORDER BY ord LIMIT 500",
    "qa_prompts": f"SELECT ord, coalesce(source, '') AS source, coalesce(lang, '') AS lang, md5(replace(CASE WHEN lang = 'de' THEN {q(PROMPT_DE)} ELSE {q(PROMPT_EN)} END, '{{text}}', {strip('substr(text, 1, 2000)')})) AS digest FROM corpus WHERE length(text) >= 300",
    "token_offsets": f"WITH {STREAM} SELECT ord, start, len(ids)::BIGINT AS n FROM o",
    "pack_sequences": f"WITH {STREAM} SELECT chunk::BIGINT AS chunk, md5(array_to_string(ids, ',')) AS digest FROM kept",
    "pack_attention_mask": f"WITH {STREAM} SELECT chunk::BIGINT AS chunk, n::BIGINT AS n_real, TRUE AS labels_equal FROM kept",
    "union_sources": "SELECT r AS source_rank, count(*) AS n, count(CASE WHEN r = 0 THEN lang END) AS n_lang, count(CASE WHEN r > 0 THEN file END) AS n_file, min(ord) AS first_ord FROM (SELECT *, CASE source WHEN 'wikipedia' THEN 0 WHEN 'pdf' THEN 1 WHEN 'markdown' THEN 2 END AS r FROM corpus) WHERE r IS NOT NULL GROUP BY r",
    "union_alpaca": f"SELECT source, count(*) AS n FROM (SELECT source FROM ({TITLE_ROW}) UNION ALL SELECT source FROM sft_qa_llm) GROUP BY source",
    "holdout_split": f"SELECT CASE WHEN {choice('1000000', q('42'), 'pair_id::VARCHAR', q('split'))} < 10000 THEN 'validation' ELSE 'train' END AS split, count(*) AS n, min(pair_id) AS first_id FROM sft_qa_llm GROUP BY 1",
    "path_components": "SELECT pdf_no, p[1] AS top, row_number() OVER (PARTITION BY p[1] ORDER BY p) AS rank FROM (SELECT pdf_no, string_split(file, '/') AS p FROM pdfs)",
    "checksum_lookup": "SELECT filename, min(lower(md5)) AS md5 FROM checksums WHERE md5 IS NOT NULL AND filename IS NOT NULL GROUP BY filename",
    "text_md5": "SELECT ord, md5(text) AS md5 FROM corpus",
    "near_dedup": f"WITH RECURSIVE {GREEDY} SELECT ord, status FROM final",
    "stage_counters": f"WITH RECURSIVE {GREEDY} SELECT status, count(*) AS n FROM final GROUP BY status",
    "clean_corpus": f"WITH RECURSIVE {GREEDY} SELECT ord, md5(text) AS digest FROM final WHERE status = 'kept'",
    "markdown_to_text": f"SELECT doc_id, {markdown('text')} AS text FROM documents",
    "qa_parse": f"WITH RECURSIVE {PARSED} SELECT * FROM parsed",
    "corpus_json": f"SELECT ord, {JSON} AS json FROM corpus",
    "wiki_records": f"SELECT ord, id, title, url, md5({strip('text')}) AS digest, 'wikipedia' AS source, 'de' AS lang FROM corpus WHERE {LABEL} = 'wikipedia' AND length({strip('text')}) >= 200",
    "markdown_files": f"SELECT ord, file AS id, translate({STEM}, '_-', '  ') AS title, md5(t) AS digest FROM (SELECT ord, file, {markdown('text')} AS t FROM corpus WHERE {LABEL} = 'markdown' AND file IS NOT NULL) WHERE length(t) >= 200",
    "source_union": f"SELECT ord, CASE {LABEL} WHEN 'wikipedia' THEN 0 WHEN 'pdf' THEN 1 WHEN 'markdown' THEN 2 ELSE 3 END AS source_rank, md5(text) AS digest FROM corpus",
    "first_checksums": "SELECT filename, arg_min(lower(md5), n) AS md5 FROM (SELECT md5, filename, row_number() OVER () AS n FROM checksums) WHERE md5 IS NOT NULL AND filename IS NOT NULL GROUP BY filename",
    "jsonl_scan": "SELECT md5(text) AS digest, source, count(*) AS n FROM corpus GROUP BY ALL",
    "text_scan": "SELECT md5(text) AS digest, count(*) AS n FROM corpus GROUP BY ALL",
    "lang_codes": "SELECT lang, count(*) AS n, lang || 'wiki-latest-pages-articles.xml.bz2' AS filename FROM corpus WHERE regexp_full_match(lang, '[a-z]{2,5}') GROUP BY lang",
    "corpus_holdout": f"SELECT ord FROM corpus WHERE {choice('1000000', q('42'), 'ord::VARCHAR', q('split'))} < 2000",
    "qa_progress": f"WITH RECURSIVE {PARSED} SELECT d.source, d.n_docs, coalesce(p.n_pairs, 0) AS n_pairs FROM (SELECT coalesce(source, '') AS source, count(*) AS n_docs FROM qa_raw GROUP BY 1) d LEFT JOIN (SELECT source, count(*) AS n_pairs FROM parsed GROUP BY source) p USING (source)",
    "packed_tokens": f"WITH RECURSIVE {RANK_STREAM} SELECT chunk::BIGINT AS chunk, md5(array_to_string(ids, ',')) AS digest FROM kept",
}
