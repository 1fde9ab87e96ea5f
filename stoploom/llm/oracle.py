"""DuckDB SQL beside the queries that SQL can express, each written on its own."""

from __future__ import annotations

#: Fixed values of the quality rules, written here once more.
_LINE_LIMIT = 0.30
_WINDOW_LIMITS = {3: 0.30, 4: 0.27, 5: 0.24, 6: 0.22, 7: 0.20, 8: 0.18, 9: 0.165, 10: 0.15}

_WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    widths = sorted({*_WINDOW_LIMITS, 8})
    windows, flags, covers, sums, limits = [], [], [], [], []
    for n in widths:
        ahead = ", ".join(f"lead(w, {k}) OVER p" for k in range(n))
        windows.append(f"CASE WHEN lead(w, {n - 1}) OVER p IS NOT NULL THEN [{ahead}] END AS g{n}")
        flags.append(f"(g{n} IS NOT NULL AND row_number() OVER (PARTITION BY rid, g{n} ORDER BY i) > 1)::INT AS f{n}")
        covers.append(f"max(f{n}) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}")
        sums.append(f"coalesce(sum(length(w)) FILTER (WHERE c{n} = 1), 0) AS chars{n}")
    # the base rule counts first occurrences, too
    flags.append("CASE WHEN g8 IS NULL THEN 0 WHEN count(*) OVER (PARTITION BY rid, g8) > 1 THEN 1 ELSE 0 END AS base")
    covers.append("max(base) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS based")
    for n, most in _WINDOW_LIMITS.items():
        limits.append(f"coalesce(chars{n}, 0) <= {most}::DOUBLE * coalesce(word_chars, 0)")
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS ws FROM docs),
    words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
    grams AS (SELECT rid, w, i, {", ".join(windows)} FROM words WINDOW p AS (PARTITION BY rid ORDER BY i)),
    flags AS (SELECT rid, w, i, {", ".join(flags)} FROM grams),
    covers AS (SELECT rid, w, {", ".join(covers)} FROM flags),
    sums AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, sum(based) AS n_repeat_words,
                    {", ".join(sums)} FROM covers GROUP BY rid),
    lines AS (SELECT rid, line, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS chars, count(*) AS n
              FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
              WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line),
    dups AS (SELECT rid, sum(n - 1) AS n_dup_lines, sum(chars - chars // n) AS dup_chars FROM lines GROUP BY rid),
    base AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                    coalesce(n_words, 0) < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                    coalesce(dup_chars, 0) <= {_LINE_LIMIT}::DOUBLE * coalesce(word_chars, 0)
                    AND {" AND ".join(limits)} AS clean
             FROM docs LEFT JOIN sums USING (rid) LEFT JOIN dups USING (rid))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND clean AS kept FROM base
    """



def _warc() -> str:
    return """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    best AS (SELECT html, max(page_id) AS best FROM p GROUP BY html),
    d AS (SELECT p.*, best, sha1(p.html) AS hex FROM p JOIN best USING (html))
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(hex, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1) FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM best THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to
    FROM d
    """


def _urls() -> str:
    number = "('0x' || substr(md5(pattern), 1, 6))::INT"
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
    rules = [
        ("malware", True, "domain", "host", "v % 3 = 0", "v % 200", True),
        ("malware", True, "domain", "host", "v % 6 = 0", "v % 200 + 30 + v % 90", False),
        ("malware", True, "domain", "host", "v % 15 = 0", "v % 200 + 150", True),
        ("adult", True, "domain", "site", "v % 7 = 0", "v % 300", True),
        ("ads", True, "path", "path", "v % 5 = 0", "v % 250", True),
        ("ads", True, "path", "path", "v % 5 = 0", "v % 250 + 60", False),
        ("partners", False, "domain", "host", "v % 4 = 1", "v % 100", True),
        ("takedown", True, "url", "url", "v % 11 = 0", "v % 360", True),
    ]
    entries = " UNION ALL ".join(
        f"SELECT '{n}' AS list, {b} AS blocks, '{k}' AS kind, pattern, DATE '2024-01-01' + ({d})::INT AS day, {x} AS listed "
        f"FROM numbered WHERE of = '{o}' AND {w}"
        for n, b, k, o, w, d, x in rules
    )
    return rf"""
    WITH captures AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT AS day FROM pages),
    parsed AS (SELECT DISTINCT url,
        nullif(regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(url, '{scheme}([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '\.$', ''), '') AS host,
        [s FOR s IN string_split(regexp_extract(url, '{scheme}[^/?#]*([^?#]*)', 1), '/') IF s <> ''] AS steps,
        regexp_replace(url, '#.*$', '') AS plain FROM captures),
    known AS (SELECT *, string_split(host, '.') AS labels FROM parsed WHERE host IS NOT NULL),
    patterns AS (SELECT DISTINCT 'host' AS of, host AS pattern FROM known
        UNION SELECT 'site', array_to_string(labels[greatest(len(labels) - 1, 1):], '.') FROM known
        UNION SELECT 'path', CASE WHEN len(steps) > 0 THEN host || '/' || steps[1] ELSE host END FROM known
        UNION SELECT 'url', plain FROM known),
    numbered AS (SELECT of, pattern, {number} AS v FROM patterns),
    entries AS ({entries}),
    daily AS (SELECT list, kind, pattern, day, bool_and(listed) AS listed, bool_and(blocks) AS blocks FROM entries GROUP BY ALL),
    changes AS (SELECT * FROM daily QUALIFY listed IS DISTINCT FROM coalesce(lag(listed) OVER (PARTITION BY list, kind, pattern ORDER BY day), false)),
    spans AS (SELECT list, blocks, kind, pattern, listed, day AS since, lead(day) OVER (PARTITION BY list, kind, pattern ORDER BY day) AS until FROM changes),
    keyed AS (SELECT url, 'domain' AS kind, unnest([array_to_string(labels[i:], '.') FOR i IN range(1, len(labels) + 1)]) AS pattern FROM known
        UNION SELECT url, 'path', unnest([array_to_string(list_concat([host], steps[:i]), '/') FOR i IN range(0, len(steps) + 1)]) FROM known
        UNION SELECT url, 'url', plain FROM known),
    active AS (SELECT DISTINCT c.url, c.day, s.list, s.kind, s.pattern, s.blocks FROM captures c JOIN keyed k USING (url)
        JOIN spans s ON s.kind = k.kind AND s.pattern = k.pattern AND s.listed AND s.since <= c.day AND (s.until IS NULL OR c.day < s.until)),
    verdicts AS (SELECT url, day, bool_and(blocks) AS blocked, count(*) AS n_active,
        array_to_string(list_sort(list(DISTINCT list)), ',') AS lists, min(list || '|' || kind || '|' || pattern) AS first_active
        FROM active GROUP BY url, day)
    SELECT page_id, c.url, c.day, coalesce(blocked, false) AS blocked, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists, first_active
    FROM captures c LEFT JOIN verdicts v ON v.url = c.url AND v.day = c.day
    """


def _mixing() -> str:
    return r"""
    WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                         md5(coalesce(doc_id::VARCHAR, 'null') || ':7') AS mark FROM documents),
    src AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
    ranked AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM src),
    levels AS (SELECT *, 3 * source_size AS cap, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::BIGINT::DOUBLE
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS level,
                      row_number() OVER (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST) AS place
               FROM ranked WINDOW w AS (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    one AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
    target AS (SELECT source, source_size, least(cap::DOUBLE, one.level * weight) AS target FROM levels, one),
    quota AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM target),
    cums AS (SELECT docs.*, source_size, target, times, target - times * source_size AS rest,
                    coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY mark, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
             FROM docs JOIN quota ON docs.source IS NOT DISTINCT FROM quota.source)
    SELECT doc_id, size, source_size, target,
           CASE WHEN size > 0 THEN (times + (2 * before + size <= 2 * rest)::INT) * size ELSE 0 END::BIGINT AS taken
    FROM cums
    """


def _crc32(text: str, table: str) -> str:
    """Checksum of a text's bytes; ``table``: the 256 remainders as a list."""
    step = f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex({text}), '..')], {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_REMAINDERS = """(SELECT [list_reduce([k::BIGINT FOR k IN range(8)], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT)
        FOR i IN range(256)] AS t)"""


def _sharding() -> str:
    def draw(name: str, weight: int) -> str:
        return f"ln((('0x' || substr(md5(key || '@' || {name}), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496) / {weight}"

    def best(options: list[tuple[str, int]]) -> str:
        return "list_max([" + ", ".join(f"{{'d': {draw(n, w)}, 'n': {n}}}" for n, w in options) + "]).n"

    # the rack's shards: region * 8 + rack * 4 + 0 .. 3; the tree of one more shard has a region 2 of weight 1
    rack = best([("region || '/0'", 4), ("region || '/1'", 4)])
    first = "(region::INT * 8 + split_part(rack, '/', 2)::INT * 4"
    shard = best([(f"rack || '/' || {first} + {k})", 1) for k in range(4)])
    grown = best([("'0'", 8), ("'1'", 8), ("'2'", 1)])
    return f"""
    WITH crc AS {_REMAINDERS},
    docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || doc_id, 'null') AS key FROM documents),
    facts AS (SELECT doc_id, key, (strlen(text) + 1)::BIGINT AS size, CASE WHEN text = '' THEN 0::BIGINT ELSE {_crc32("text", "t")} END AS text_crc32 FROM docs, crc),
    regions AS (SELECT *, {best([("'0'", 8), ("'1'", 8)])} AS region, {grown} AS grown FROM facts),
    racks AS (SELECT *, {rack} AS rack FROM regions),
    placed AS (SELECT *, split_part({shard}, '/', 3)::INT AS shard FROM racks)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY md5(key || '|=' || size || '|=' || text_crc32), doc_id, size, text_crc32) - 1 AS slot,
           CASE WHEN grown = '2' THEN 16 ELSE shard END AS grown_shard
    FROM placed
    """


def _repair() -> str:
    nexts = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def put(cost: str, letter: str, state: int) -> str:
        return f"CASE WHEN v{state} IS NOT NULL THEN {{'c': v{state}.c + {cost}, 'a': '{letter}' || v{state}.a}} END"

    def least(ways: list[str]) -> str:
        return f"list_min([x FOR x IN [{', '.join(ways)}] IF x IS NOT NULL])"

    def inserts(source: str, more: str) -> str:
        columns = [least([f"v{q}", *(put("5", "I", to) for c, to in nexts[q].items() if c in "ua")]) + f" AS v{q}" for q in range(4)]
        return f"(SELECT {more}, {', '.join(columns)} FROM {source})"

    columns = []
    for q in range(4):
        ways = [put("2", "D", q)]
        for c, to in nexts[q].items():
            ways.append(f"CASE WHEN fault NOT IN (1, 2) AND initial = '{c}' THEN {put('5 * (fault = 3)::INT', 'K', to)} END")
            if c in "ua":
                ways.append(f"CASE WHEN fault NOT IN (1, 2) THEN {put('1 + 5 * (fault = 3)::INT', 'R', to)} END")
        columns.append(f"{least(ways)} AS v{q}")
    step = f"(SELECT k.conv, dp.i - 1 AS i, {', '.join(columns)} FROM dp JOIN faulty k ON k.conv = dp.conv AND k.i = dp.i)"
    nothing = "{'c': 0::BIGINT, 'a': ''}"
    ends = f"(SELECT conv, n AS i, {nothing} AS v0, NULL::STRUCT(c BIGINT, a VARCHAR) AS v1, NULL::STRUCT(c BIGINT, a VARCHAR) AS v2, {nothing} AS v3 FROM per)"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE crc AS {_REMAINDERS},
    turns AS (SELECT coalesce(conv_id::VARCHAR, 'null') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))", "t")} % 20 AS kind FROM conversations, crc),
    damaged AS (SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                       CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                FROM turns, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies(c)),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(role), md5(text)) AS i,
                        right(rtrim(text, {blanks}), 1) AS tail, role[1:1] AS initial FROM damaged),
    faulty AS (SELECT *, CASE WHEN tail = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
                              WHEN tail NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                      lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM numbered),
    per AS (SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv),
    dp AS (SELECT * FROM {inserts(inserts(ends, "conv, i"), "conv, i")}
           UNION ALL SELECT * FROM {inserts(inserts(step, "conv, i"), "conv, i")}),
    plans AS (SELECT conv, v0.c AS cost, v0.a AS audit FROM dp WHERE i = 0),
    -- no cheapest list holds an insert, so edit i is row i's
    edited AS (SELECT f.conv, f.i, f.role, f.text, f.initial, substr(audit, f.i::INT, 1) AS edit FROM faulty f JOIN plans USING (conv)),
    left_over AS (SELECT *, row_number() OVER w - (first_value(edit = 'K' AND initial = 's') OVER w)::INT AS k FROM edited WHERE edit <> 'D'
                  WINDOW w AS (PARTITION BY conv ORDER BY i)),
    joined AS (SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS t
               FROM left_over GROUP BY conv)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS conv FROM conversations) c
    LEFT JOIN per USING (conv) LEFT JOIN plans USING (conv) LEFT JOIN joined USING (conv)
    """


ORACLE: dict[str, str] = {
    "op3_warc": _warc(),
    "op5_url_filters": _urls(),
    "op7_quality_rules": _quality(),
    "op10_mixing": _mixing(),
    "op11_sharding": _sharding(),
    "op13_conversation_repair": _repair(),
}
