"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from tidewarden.llm import mixing, rules, spelling, urls

CHAT = """
WITH distinct_turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS rank
  FROM distinct_turns),
whole AS (
  SELECT conv_id, count(*) AS n_turns, list([role, text] ORDER BY rank) AS turns
  FROM ranked GROUP BY conv_id),
one_of_equal AS (
  SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS equal
  FROM whole GROUP BY turns, n_turns),
kept AS (
  SELECT conv_id, n_turns, equal FROM one_of_equal a
  WHERE NOT EXISTS (SELECT 1 FROM whole b WHERE b.n_turns > a.n_turns AND b.turns[1] = a.turns[1]
                    AND list_slice(b.turns, 1, a.n_turns) = a.turns)),
blocks AS (
  SELECT conv_id, floor(turn / 64) AS block, count(*) AS turns,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                    ORDER BY rank) AS text
  FROM ranked GROUP BY conv_id, block)
SELECT conv_id, n_turns, equal,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY block) - 1 AS INTEGER) AS piece,
       turns, text
FROM kept JOIN blocks USING (conv_id)"""

# Base 32: each letter is five of the digest's 160 bits.
WARC = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, (5 * i + 1)::INTEGER, 5)
                                                    AS BIGINT)) AS five FROM digests),
named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(five, lambda b:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((b >> 15) & 31)::INTEGER + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((b >> 10) & 31)::INTEGER + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((b >> 5) & 31)::INTEGER + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (b & 31)::INTEGER + 1, 1)), '')
         AS payload_digest FROM bits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       nullif(min(page_id) OVER same, page_id) AS refers_to
FROM named WINDOW same AS (PARTITION BY payload_digest)"""


def _rules() -> str:
    parts = " ".join(f"WHEN '{k}' THEN {v[3][0]}" for k, v in rules.RATES.items())
    ofs = " ".join(f"WHEN '{k}' THEN {v[3][1]}" for k, v in rules.RATES.items())
    two_sided = ", ".join(f"'{name}'" for name in rules.TWO_SIDED)

    def width(edge: str) -> str:
        return f"CASE WHEN {edge} < 16 THEN 1 ELSE 1 << (len(bin({edge})) - 5) END"

    def fences(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name} AS (
  SELECT {by}rate, docs * (o - part) >= {rules.BEYOND} * o AS enough,
         high + {rules.FENCE} * greatest({width("high")}, high - median) AS most,
         low - {rules.FENCE} * greatest({width("low")}, median - low) AS least
  FROM (SELECT {by}rate, max(docs) AS docs, max(part) AS part, max(o) AS o,
               min(edge) FILTER (2 * run >= docs) AS median,
               min(edge) FILTER (o * run >= part * docs) AS high,
               min(edge) FILTER (o * run >= (o - part) * docs) AS low
        FROM (SELECT *, sum(n) OVER (PARTITION BY {by}rate ORDER BY edge) AS run,
                     sum(n) OVER (PARTITION BY {by}rate) AS docs,
                     CASE rate {parts} END AS part, CASE rate {ofs} END AS o
              FROM (SELECT {by}rate, edge, count(*) AS n FROM edges WHERE NOT base_failed
                    GROUP BY {by}rate, edge))
        GROUP BY {by}rate))"""

    rates = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, base_failed, '{name}' AS rate, "
        f"{factor} * {above} // greatest({below}, 1) AS v FROM counts"
        for name, (above, factor, below, *_) in rules.RATES.items())
    return f"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                     lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n
                         FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed
  FROM split LEFT JOIN repeats USING (doc_id)),
rates AS ({rates}),
edges AS (
  SELECT doc_id, lang, source, base_failed, rate, v,
         CASE WHEN v < 16 THEN v
              ELSE (((v >> (len(bin(v)) - 5)) + 1) << (len(bin(v)) - 5)) - 1 END AS edge
  FROM rates),
{fences("own", "lang, source")},
{fences("of_lang", "lang")},
{fences("of_all", "")},
beyond AS (
  SELECT DISTINCT e.doc_id FROM edges e
  JOIN own o ON e.lang IS NOT DISTINCT FROM o.lang AND e.source IS NOT DISTINCT FROM o.source
       AND e.rate = o.rate
  JOIN of_lang l ON e.lang IS NOT DISTINCT FROM l.lang AND e.rate = l.rate
  JOIN of_all a ON e.rate = a.rate
  WHERE e.v > CASE WHEN o.enough THEN o.most WHEN l.enough THEN l.most ELSE a.most END
     OR e.rate IN ({two_sided})
        AND e.v < CASE WHEN o.enough THEN o.least WHEN l.enough THEN l.least ELSE a.least END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM beyond) AS kept
FROM counts"""


RULES = _rules()

MIX = f"""
WITH sources AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
rated AS (
  SELECT source, pow(docs::DOUBLE, 0.5) / (SELECT sum(pow(docs::DOUBLE, 0.5)) FROM sources)
                 * (SELECT count(*) FROM documents)::DOUBLE / docs AS rate FROM sources),
drawn AS (
  SELECT *, greatest(ceil(rate / {mixing.STEP}), 1)::BIGINT AS draws FROM rated),
reach AS (
  SELECT source, draws, k, sum(CASE WHEN rate > 0 THEN
           exp(k * ln(rate / draws) - rate / draws - lgamma(k + 1)) ELSE (k = 0)::INT END)
           OVER (PARTITION BY source ORDER BY k) AS p
  FROM drawn, range({mixing.COUNTS}) AS r(k)),
numbers AS (
  SELECT doc_id, source, CAST('0x' || substr(md5('mix|' || doc_id || '|' || draw), 1, 13) AS BIGINT)
           / pow(2::DOUBLE, 52) AS u
  FROM (SELECT doc_id, source, unnest(range(1, draws + 1)) AS draw
        FROM documents JOIN drawn USING (source))),
copies AS (
  SELECT doc_id, count(*) AS n FROM numbers JOIN reach USING (source) WHERE p <= u GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       md5('mix|' || doc_id || '|copy|' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(n)) AS copy FROM documents JOIN copies USING (doc_id))"""


def _urls() -> str:
    host = ("translate(regexp_extract(rest({0}), '^([^/?#]*)', 1), "
            f"'{urls.UPPER}', '{urls.LOWER}')")
    listed = [("block", "net", "/"), ("allow", "example.net", "/en/"),
              ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    values = ", ".join(f"('{v}', '{h}', '{p}', '{h}{p}')" for v, h, p in listed)

    def rest(url: str) -> str:
        return (f"CASE WHEN instr({url}, '://') > 0 "
                f"THEN substr({url}, instr({url}, '://') + 3) ELSE '' END")

    def host_sql(url: str) -> str:
        return host.replace("rest({0})", rest(url))

    link = "(?i)\\b(?:href|src)\\s*=\\s*[\"'']?\\s*((?:https?:)?//[^\"''\\s<>]+)"
    return f"""
WITH RECURSIVE placed AS (
  SELECT page_id, coalesce({host_sql("url")}, '') AS host,
         coalesce(regexp_extract({rest("url")}, '^[^/?#]*([^?#]*)', 1), '') AS path, html
  FROM pages),
rules(verdict, bound, prefix, rule) AS (VALUES {values}),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM placed JOIN rules ON (host = bound OR ends_with(host, '.' || bound))
       AND starts_with(path, prefix) GROUP BY page_id),
ruled AS (SELECT p.*, rule, verdict FROM placed p LEFT JOIN fits USING (page_id)),
links AS (
  SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS link
  FROM placed),
targets AS (
  SELECT src, CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END AS link
  FROM links),
edges AS (
  SELECT src, dst, count(*) AS links FROM (SELECT src, {host_sql("link")} AS dst FROM targets)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
hosts AS (
  SELECT host, coalesce(2 * count(*) FILTER (verdict = 'allow') > count(page_id), false)::INT
           AS good, coalesce(2 * count(*) FILTER (verdict = 'block') > count(page_id), false)::INT
           AS bad
  FROM (SELECT host, page_id, verdict FROM ruled
        UNION ALL SELECT src, NULL, NULL FROM edges UNION ALL SELECT dst, NULL, NULL FROM edges)
  WHERE host <> '' GROUP BY host),
nodes AS (
  SELECT host, coalesce({1 - urls.EVEN} * good / nullif((SELECT sum(good) FROM hosts), 0),
                        {1 - urls.EVEN} / (SELECT count(*) FROM hosts))
               + {urls.EVEN} / (SELECT count(*) FROM hosts) AS good,
         coalesce(bad / nullif((SELECT sum(bad) FROM hosts), 0), 0) AS bad FROM hosts),
shares AS (
  SELECT 'trust' AS kind, src, dst, links / sum(links) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL
  SELECT 'distrust', dst, src, links / sum(links) OVER (PARTITION BY dst) FROM edges),
-- old: the rank before; moved: the largest change of the round.
ranks AS (
  SELECT 0 AS round, 'trust' AS kind, host, good AS seed, good AS rank, 1e300 AS moved FROM nodes
  UNION ALL SELECT 0, 'distrust', host, bad, bad, 1e300 FROM nodes
  UNION ALL
  SELECT round, kind, host, seed, rank, max(abs(rank - old)) OVER ()
  FROM (SELECT max(round) + 1 AS round, kind, host, max(seed) AS seed, max(old) AS old,
               {urls.DAMPING} * sum(got) + {1 - urls.DAMPING} * max(seed) AS rank
        FROM (SELECT round, kind, host, seed, rank AS old, 0.0 AS got FROM ranks
              WHERE moved > {urls.TOLERANCE} / (SELECT count(*) FROM nodes)
              UNION ALL
              SELECT r.round, kind, dst, NULL, NULL, r.rank * share
              FROM ranks r JOIN shares USING (kind) WHERE r.host = src
              AND moved > {urls.TOLERANCE} / (SELECT count(*) FROM nodes))
        GROUP BY kind, host)),
last AS (SELECT kind, host, rank FROM ranks WHERE round = (SELECT max(round) FROM ranks))
SELECT page_id, r.host, path, rule,
       coalesce(verdict, CASE WHEN d.rank > t.rank THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN last t ON t.kind = 'trust' AND t.host = r.host
LEFT JOIN last d ON d.kind = 'distrust' AND d.host = r.host"""


URLS = _urls()

# The checksum takes each byte and then eight bits; -1 stands for a bit.
CRC32 = """xor(list_reduce(flatten(list_transform({codes}, lambda c: [c, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
  4294967295::BIGINT), 4294967295)"""

_CODES = "list_transform(string_split({text}, ''), lambda d: ord(d)::BIGINT)"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


# nodes: every node of the languages' trees; names: of the tree of their roots. up and over fold a leaf.
MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {CRC32.format(codes=_CODES.format(text="doc_id::VARCHAR"))} % 7 = 0
              THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS now FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY lang, level, n, place // 2),
names AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n,
         lang, digest FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, NULL, sha256(string_agg(digest, '' ORDER BY place))
  FROM names WHERE n > 1 GROUP BY level, n, place // 2),
over AS (
  SELECT doc_id, leaf, now, lang, place, n, 0 AS level, leaf AS old, now AS folded, '' AS proof
  FROM placed
  UNION ALL
  SELECT o.doc_id, o.leaf, o.now, o.lang, o.place // 2, (o.n + 1) // 2, o.level + 1, o.old,
         sha256(CASE WHEN o.place % 2 = 1 THEN coalesce(s.digest, '') || o.folded
                     ELSE o.folded || coalesce(s.digest, '') END), o.proof || coalesce(s.digest, '')
  FROM over o LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM o.lang AND s.level = o.level
                               AND s.place = xor(o.place, 1)
  WHERE o.n > 1),
tops AS (
  SELECT o.doc_id, o.leaf, b.digest AS subroot, b.place, b.n, 0 AS level, o.folded, o.proof
  FROM over o JOIN names b ON b.level = 0 AND b.lang IS NOT DISTINCT FROM o.lang WHERE o.n = 1
  UNION ALL
  SELECT o.doc_id, o.leaf, o.subroot, o.place // 2, (o.n + 1) // 2, o.level + 1,
         sha256(CASE WHEN o.place % 2 = 1 THEN coalesce(s.digest, '') || o.folded
                     ELSE o.folded || coalesce(s.digest, '') END), o.proof || coalesce(s.digest, '')
  FROM tops o LEFT JOIN names s ON s.level = o.level AND s.place = xor(o.place, 1)
  WHERE o.n > 1)
SELECT doc_id, leaf, subroot, (SELECT digest FROM names WHERE n = 1) AS root,
       sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = (SELECT digest FROM names WHERE n = 1) AS verified
FROM tops WHERE n = 1"""

# U+00C0 to U+00FF are the bytes 195 and 128 to 191.
_BYTES = ("flatten(list_transform(string_split({text}, ''), lambda d: CASE WHEN ord(d) < 128 "
          "THEN [ord(d)::BIGINT] ELSE [195, (ord(d) - 64)::BIGINT] END))")

# Distances are told by the place that differs, as the built-in one counts bytes.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{spelling.LETTERS}')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT *, {CRC32.format(codes=_BYTES.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h
  FROM runs),
words AS (
  SELECT CASE WHEN h % {spelling.NOISE} = 0
              THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
              ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1
  HAVING length(word) >= {spelling.LEAST_LENGTH} AND sum(n) >= {spelling.LEAST_COUNT}),
places AS (
  SELECT word, unnest(range(length(word))) AS i FROM words),
replaced AS (
  SELECT word, substr(word, 1, i::INTEGER) || '*' || substr(word, i::INTEGER + 2) AS gap FROM places),
deleted AS (
  SELECT word, substr(word, 1, i::INTEGER) || substr(word, i::INTEGER + 2) AS less FROM places),
near AS (
  SELECT a.word, b.word AS other FROM replaced a JOIN replaced b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT d.word, w.word FROM deleted d JOIN words w ON d.less = w.word
  UNION SELECT w.word, d.word FROM deleted d JOIN words w ON d.less = w.word),
ranked AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS rank
  FROM near JOIN words ON words.word = other),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN r.n >= 2 * w.n THEN other END AS form, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.rank = 1),
steps AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s USING (word)
JOIN forms t ON t.word = s.root WHERE t.form IS NULL"""

# A word is removed if a window that starts at it or up to 49 words before it is; null ids are the smallest.
REPEATS = """
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                     lambda w: w <> '') AS words FROM documents),
places AS (
  SELECT rid, doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM split),
windows AS (
  SELECT rid, doc_id, place, array_to_string(list_slice(words, place::INTEGER + 1, place::INTEGER + 50),
                                             ' ') AS run
  FROM (SELECT rid, doc_id, words, unnest(range(greatest(len(words) - 49, 0))) AS place FROM split)),
firsts AS (
  SELECT run, min(coalesce(doc_id, -9223372036854775808)) AS first FROM windows GROUP BY run),
starts AS (
  SELECT rid, place FROM windows JOIN firsts USING (run)
  WHERE first < coalesce(doc_id, -9223372036854775808)),
judged AS (
  SELECT p.rid, p.word, p.place, coalesce(max(s.place) OVER (PARTITION BY p.rid ORDER BY p.place)
                                          >= p.place - 49, false) AS gone
  FROM places p LEFT JOIN starts s ON s.rid = p.rid AND s.place = p.place),
kept AS (
  SELECT rid, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (rid)"""
