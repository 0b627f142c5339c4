"""SQL for DuckDB with the expected result of the queries that SQL can express."""

from __future__ import annotations

import re

from tiffin.llm import chat, lexical_search, licenses, mixing, spelling, url_filters

_LOWERED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _url_filters() -> str:
    fits = "(host = {h} OR suffix(host, {dot})) AND starts_with(path, {p})"
    found = "NULL"
    for rule in sorted(url_filters.SITE_RULES, key=lambda r: (len(r.text), r.text)):
        condition = fits.format(
            h=_quoted(rule.host), dot=_quoted("." + rule.host), p=_quoted(rule.path)
        )
        found = f"CASE WHEN {condition} THEN {_quoted(rule.text)} ELSE {found} END"
    verdicts = " ".join(
        f"WHEN {_quoted(r.text)} THEN {_quoted(r.verdict)}" for r in url_filters.SITE_RULES
    )
    blocked = []
    for pattern in url_filters.PATTERNS:
        if pattern.startswith("||"):
            text = pattern[2:]
            blocked.append(f"starts_with(target, {_quoted(text)})")
            blocked.append(f"contains(host || '/', {_quoted('.' + text)})")
        else:
            blocked.append(f"contains(target, {_quoted(pattern)})")
    return f"""
    WITH parts AS (
      SELECT page_id, {_LOWERED.format(text="regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(coalesce(url, ''), '(?s)://[^?#]*(.*)', 1) AS tail
      FROM pages),
    ruled AS (SELECT *, host || path || tail AS target, {found} AS rule FROM parts)
    SELECT page_id, host, path, rule,
      CASE rule {verdicts} ELSE CASE WHEN {" OR ".join(blocked)} THEN 'block' ELSE 'allow' END END AS verdict
    FROM ruled"""


def _license_scan() -> str:
    templates = ", ".join(
        f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.TEMPLATES.items()
    )
    words = "regexp_extract_all(" + _LOWERED + ", '[a-z0-9]+')"
    return f"""
    WITH files AS (
      SELECT doc_id, text, coalesce(source, 'none') AS src, doc_id // 100 AS g, doc_id // 10 % 10 AS s
      FROM documents),
    placed AS (
      SELECT doc_id, text, CASE WHEN doc_id % 20 = 0 THEN src || '/LICENSE.' || doc_id
        WHEN doc_id % 20 = 5 THEN src || '/g' || g || '/LICENSE.' || doc_id
        WHEN doc_id % 5 = 0 THEN src || '/g' || g || '/s' || s || '/LICENSE.' || doc_id
        ELSE src || '/g' || g || '/s' || s || '/' || doc_id || '.txt' END AS path
      FROM files),
    templates(license, body) AS (VALUES {templates}),
    template_words AS (
      SELECT license, term, count(*) AS n
      FROM (SELECT license, unnest({words.format(text="body")}) AS term FROM templates) GROUP BY ALL),
    lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM placed),
    line_words AS (
      SELECT doc_id, line_no, term, count(*) AS n
      FROM (SELECT doc_id, line_no, unnest({words.format(text="line")}) AS term FROM lines) GROUP BY ALL),
    total AS (SELECT count(*) AS lines FROM lines),
    frequency AS (
      SELECT term, count(*) AS with_term FROM line_words
      WHERE term IN (SELECT term FROM template_words) GROUP BY term),
    idf AS (
      SELECT term, ln((1 + lines) / (1 + coalesce(with_term, 0))) + 1 AS idf
      FROM (SELECT DISTINCT term FROM template_words) LEFT JOIN frequency USING (term), total),
    units AS (
      SELECT license, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY license)) AS unit
      FROM template_words JOIN idf USING (term)),
    weighed AS (
      SELECT doc_id, line_no, term,
        n * CASE WHEN term IN (SELECT term FROM template_words) THEN idf ELSE ln(1 + lines) + 1 END AS w
      FROM line_words LEFT JOIN idf USING (term), total),
    norms AS (SELECT doc_id, line_no, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
    scores AS (
      SELECT doc_id, license, round(dot / norm, 6) AS score
      FROM (SELECT doc_id, line_no, license, sum(w * unit) AS dot
            FROM weighed JOIN units USING (term) GROUP BY ALL) JOIN norms USING (doc_id, line_no)),
    own AS (
      SELECT doc_id, license, score FROM scores WHERE score >= {licenses.LEAST}
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
    handed AS (
      SELECT regexp_replace(path, '/[^/]*$', '') AS above, path AS license_path, license, score
      FROM own JOIN placed USING (doc_id) WHERE doc_id % 5 = 0),
    inherited AS (
      SELECT p.doc_id, h.license, h.score, h.license_path
      FROM placed p JOIN handed h ON starts_with(p.path, h.above || '/')
      QUALIFY row_number() OVER (PARTITION BY p.doc_id
        ORDER BY length(h.above) DESC, h.score DESC, h.license, h.license_path) = 1)
    SELECT p.doc_id, p.path, coalesce(o.license, i.license) AS license, coalesce(o.score, i.score) AS score,
      CASE WHEN o.license IS NOT NULL THEN 'own' WHEN i.license IS NOT NULL THEN 'inherited' END AS origin,
      CASE WHEN o.license IS NOT NULL THEN p.path ELSE i.license_path END AS license_path
    FROM placed p LEFT JOIN own o USING (doc_id) LEFT JOIN inherited i USING (doc_id)"""


_NEAR_DEDUP = f"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all({_LOWERED.format(text="coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
      FROM words),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
    pairs AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
      FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
      SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
      WHERE 100 * common >= 85 * (p.n + q.n - common)),
    both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached(doc_id, other) AS (
      SELECT doc_id, doc_id FROM documents
      UNION SELECT r.doc_id, b.y FROM reached r JOIN both_ways b ON b.x = r.other)
    SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
    FROM sizes s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.n"""

_WARC = """
    WITH payloads AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
      FROM pages),
    firsts AS (
      SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id < original THEN original END AS refers_to
    FROM firsts"""

_WEIGHTS = ", ".join(map(str, mixing.WEIGHTS))
_MIXING = f"""
    WITH RECURSIVE sizes AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
      FROM documents),
    totals AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1)::BIGINT AS source_rank
      FROM sizes GROUP BY source),
    weighted AS (
      SELECT *, [{_WEIGHTS}][source_rank % {len(mixing.WEIGHTS)} + 1]::BIGINT AS weight,
        source_size * {mixing.REPEATS} AS most FROM totals),
    -- Round by round, sources above their limit stop there and the others share the rest.
    rounds AS (
      SELECT 0 AS round, source_rank, weight, most, false AS stopped,
        (sum(source_size) OVER ())::BIGINT AS words_left, (sum(weight) OVER ())::BIGINT AS weight_left
      FROM weighted
      UNION ALL
      SELECT round + 1, source_rank, weight, most, stops,
        (words_left - coalesce(sum(CASE WHEN stops AND NOT stopped THEN most END) OVER (), 0))::BIGINT,
        (weight_left - coalesce(sum(CASE WHEN stops AND NOT stopped THEN weight END) OVER (), 0))::BIGINT
      FROM (SELECT *, stopped OR most * weight_left <= words_left * weight AS stops FROM rounds)
      WHERE round <= (SELECT count(*) FROM weighted)),
    targets AS (
      SELECT source_rank, CASE WHEN stopped THEN most::DOUBLE
        ELSE words_left::DOUBLE * weight / weight_left END AS target
      FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
    sources AS (
      SELECT w.source, source_rank, source_size, target, (sum(source_size) OVER ())::BIGINT AS all_words
      FROM weighted w JOIN targets USING (source_rank)),
    cut AS (
      SELECT greatest(1, (all_words + {mixing.SLOTS - 1}) // {mixing.SLOTS}) AS block, all_words
      FROM sources LIMIT 1),
    streams AS (
      SELECT doc_id, s.source_rank, size, (sum(size) OVER (PARTITION BY s.source_rank
          ORDER BY substr(md5('{mixing.SEED}|' || doc_id), 1, 12), doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
      FROM sizes z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source),
    shares AS (
      SELECT *, sum(target) OVER (ORDER BY source_rank ROWS UNBOUNDED PRECEDING) / all_words AS upto
      FROM sources),
    ranges AS (
      SELECT source_rank, coalesce(lag(upto) OVER (ORDER BY source_rank), 0) AS lower,
        CASE WHEN source_rank = max(source_rank) OVER () THEN 2 ELSE upto END AS upper,
        (source_size + block - 1) // block AS blocks
      FROM shares, cut WHERE target > 0),
    slots AS (
      SELECT i AS slot, i * {mixing.GOLDEN} % 4294967296 / 4294967296.0 AS point
      FROM cut, range((all_words + block - 1) // block) AS t(i)),
    ranked AS (
      SELECT source_rank, blocks, row_number() OVER (PARTITION BY source_rank ORDER BY slot) - 1 AS rank
      FROM slots JOIN ranges ON point >= lower AND point < upper),
    uses AS (
      SELECT source_rank, rank % blocks AS block_no, count(*) AS uses
      FROM ranked WHERE rank < blocks * {mixing.REPEATS} GROUP BY ALL),
    pieces AS (
      SELECT doc_id, source_rank, start, size, block, unnest(range(start // block, (start + size - 1) // block + 1)) AS block_no
      FROM streams, cut WHERE size > 0),
    taken AS (
      SELECT doc_id, sum((least(start + size, (block_no + 1) * block) - greatest(start, block_no * block)) * uses) AS taken
      FROM pieces JOIN uses USING (source_rank, block_no) GROUP BY doc_id)
    SELECT doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
    FROM streams JOIN sources USING (source_rank) LEFT JOIN taken USING (doc_id)"""

_DECONTAMINATION = f"""
    WITH doc_words AS (
      SELECT doc_id, regexp_extract_all({_LOWERED.format(text="coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    item_words AS (
      SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWERED.format(text="coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS pattern, least(len(w), 10) AS n
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
    places AS (
      SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
    runs AS (
      SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
      FROM places, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)),
    found AS (SELECT doc_id, i, n, item FROM runs JOIN windows USING (pattern, n)),
    hits AS (
      SELECT doc_id, count(DISTINCT word) AS n_hit
      FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
      FROM found GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

# The table t of a CRC-32, by bytes, and the CRC-32 of a text with it.
_CRC_STEPS = """crc_table(n, k, c) AS (
      SELECT range, 0, range FROM range(256)
      UNION ALL
      SELECT n, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8),
    steps AS (SELECT list(c ORDER BY n) AS t FROM crc_table WHERE k = 8)"""
_CRC32 = """xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(
          regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda crc, byte: xor(crc >> 8, t[xor(crc & 255, byte) + 1])), 4294967295)"""

_SHARDING = f"""
    WITH RECURSIVE {_CRC_STEPS},
    sizes AS (
      SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {_CRC32.format(text="coalesce(text, '')")} AS text_crc32
      FROM documents, steps),
    placed AS (
      SELECT *, least(23, ((sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size + size // 2)
        * 24 // sum(size) OVER ()))::INTEGER AS shard FROM sizes)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
    FROM placed"""

_EXACT_DEDUP = """
    WITH texts AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM texts"""



def _escaped(text: str) -> str:
    template = chat.Template()
    for first in sorted({c[0] for c in (*template.marks, *template.reserved)}):
        tails = [c[1:] for c in (*template.marks, *template.reserved) if c[0] == first]
        pattern = rf"(\{first})(\\*(?:{'|'.join(map(re.escape, tails))}))"
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(chr(92) + '1' + chr(92) * 2 + chr(92) + '2')}, 'g')"
    return text


_CHAT_FORMAT = f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
      sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum({sum(map(len, chat.Template().marks))} + length({_escaped("role")}) + length({_escaped("text")}))::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id"""

_TERMS = "regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(
    text=_LOWERED.format(text="coalesce(text, '')")
)
_LEXICAL_SEARCH = f"""
    WITH documents_terms AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
    sized AS (SELECT doc_id, len(terms)::BIGINT AS n, terms FROM documents_terms WHERE len(terms) > 0),
    totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sized),
    item_terms AS (
      SELECT item, item_id, unnest(list_distinct(terms)) AS term
      FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark)),
    held AS (
      SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM sized)
      WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
    weights AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM held, totals GROUP BY term, docs),
    marks AS (SELECT doc_id, 50 + (50 * n * docs) // all_terms AS m FROM sized, totals),
    impacts AS (
      SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact
      FROM held JOIN weights USING (term) JOIN marks USING (doc_id)),
    scores AS (
      SELECT item, item_id, doc_id, sum(impact)::BIGINT AS score
      FROM item_terms JOIN impacts USING (term) GROUP BY ALL HAVING sum(impact) > 0)
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores QUALIFY rank <= {lexical_search.BEST}"""

_SPELLING = f"""
    WITH RECURSIVE {_CRC_STEPS},
    runs AS (
      SELECT doc_id, unnest(regexp_extract_all({_LOWERED.format(text="coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
      FROM documents),
    found AS (
      SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS times FROM runs
      WHERE length(run) >= {spelling.LEAST_CHARS} GROUP BY ALL),
    marked AS (
      SELECT run, times, {_CRC32.format(text="id || ':' || run")} AS mark FROM found, steps),
    spelled AS (
      SELECT times, CASE WHEN mark % 199 = 0
        THEN substr(run, 1, (mark % length(run))::INTEGER) || substr(run, (mark % length(run))::INTEGER + 2) ELSE run END AS word
      FROM marked),
    words AS (
      SELECT word, sum(times)::BIGINT AS n FROM spelled WHERE length(word) >= {spelling.LEAST_CHARS}
      GROUP BY word HAVING sum(times) >= {spelling.LEAST_TIMES}),
    -- Every word without one of its letters, by its place.
    less AS (
      SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INTEGER AS place FROM words)),
    near AS (
      SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (rest, place) WHERE a.word != b.word
      UNION SELECT l.word, l.n, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
      UNION SELECT w.word, w.n, l.word, l.n FROM less l JOIN words w ON w.word = l.rest),
    best AS (
      SELECT word, other AS form, other_n AS form_n, count(*) OVER (PARTITION BY word) AS n_near
      FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
    judged AS (
      SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {spelling.RATIO} * n THEN form END AS form,
        CASE WHEN form_n >= {spelling.RATIO} * n THEN form_n END AS form_n
      FROM words LEFT JOIN best USING (word)),
    followed(word, root, next) AS (
      SELECT word, word, form FROM judged
      UNION ALL SELECT f.word, f.next, j.form FROM followed f JOIN judged j ON j.word = f.next)
    SELECT j.word, j.form, f.root, j.n, j.n_near, j.form_n FROM judged j JOIN followed f ON f.word = j.word AND f.next IS NULL"""


def statements() -> dict[str, str]:
    return {
        "op1_url_filters": _url_filters(),
        "op2_license_scan": _license_scan(),
        "op4_near_dedup": _NEAR_DEDUP,
        "op5_warc": _WARC,
        "op6_mixing": _MIXING,
        "op7_decontamination": _DECONTAMINATION,
        "op8_sharding": _SHARDING,
        "op10_exact_dedup": _EXACT_DEDUP,
        "op11_chat_format": _CHAT_FORMAT,
        "op12_lexical_search": _LEXICAL_SEARCH,
        "op13_spelling_variants": _SPELLING,
    }
