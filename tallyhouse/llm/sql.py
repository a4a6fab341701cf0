"""The corpus queries as SQL, where SQL can express them.

No SQL: fingerprints need XXH64 (op1), compression ratios zstandard (op2), 400-byte windows at
every byte are too many rows (op6), the classifier is trained (op7), tokens need a vocabulary
(op8), and the mix carries what one size class misses to the next (op9). Those queries are tested
against brute force.
"""

from __future__ import annotations

from tallyhouse.llm import collocations, lines, urls
from tallyhouse.llm.common import LOWER, UPPER
from tallyhouse.llm.decontaminate import WINDOW
from tallyhouse.llm.queries import URL_RULES

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def _bit(i: str, place: int) -> str:
    return f"{1 << (4 - place)} * CAST(substr(bits, {i} * 5 + {place + 1}, 1) AS INTEGER)"


WARC = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, CAST(from_hex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits
    FROM pages
), d AS (
    SELECT page_id, strlen(payload) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('{_LETTERS}', CAST(1 + {" + ".join(_bit("i", k) for k in range(5))} AS BIGINT), 1)), '') AS payload_digest,
           min(page_id) OVER (PARTITION BY payload) AS first_id
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

_ROLLED = " + ".join(
    f"{lines.BASE**back} * coalesce(lag(h, {back}) OVER by_line, 0)" if back else "h" for back in range(lines.WINDOW)
)

LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM split
), filled AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, count(*) OVER (PARTITION BY doc_id) AS m,
           CAST('0x' || substr(md5(lines[i]), 1, 8) AS BIGINT) AS h
    FROM numbered WHERE trim(lines[i], ' ') <> ''
), ending AS (
    SELECT doc_id, i, k, m, k = m OR ({_ROLLED}) % {lines.DIVISOR} <> 0 AS ends
    FROM filled WINDOW by_line AS (PARTITION BY doc_id ORDER BY k)
), spans AS (
    SELECT s.doc_id, s.i AS first,
           coalesce(min(e.i) FILTER (WHERE e.ends), max(e.i)) AS last
    FROM ending s JOIN ending e
      ON s.doc_id = e.doc_id AND e.k BETWEEN s.k + {lines.LEAST_LINES - 1} AND s.k + {lines.MOST_LINES - 1}
    GROUP BY s.doc_id, s.i
), judged AS (
    SELECT p.doc_id, first, last, row_number() OVER same AS place, count(*) OVER (PARTITION BY body) AS times
    FROM (SELECT p.doc_id, first, last, array_to_string(lines[first:last], chr(10)) AS body FROM spans p JOIN split s ON p.doc_id = s.doc_id) p
    WINDOW same AS (PARTITION BY body ORDER BY p.doc_id, first)
), gone AS (
    SELECT doc_id, unnest(range(first, last + 1)) AS i FROM judged WHERE place > 1
    EXCEPT
    SELECT doc_id, unnest(range(first, last + 1)) FROM judged WHERE place = 1 AND times > 1
), kept AS (
    SELECT n.doc_id, string_agg(n.lines[n.i], chr(10) ORDER BY n.i) AS body
    FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i GROUP BY n.doc_id
), counted AS (
    SELECT doc_id, count(*) AS removed, count(*) FILTER (WHERE lead_in) AS parts
    FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) <> i - 1, TRUE) AS lead_in FROM gone) r
    GROUP BY doc_id
)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(s.lines) END AS BIGINT) AS n_lines,
       CAST(coalesce(g.removed, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(g.parts, 0) AS BIGINT) AS n_removed_chunks,
       CAST(length(coalesce(k.body, '')) AS BIGINT) AS kept_chars, sha256(coalesce(k.body, '')) AS kept_sha256
FROM documents d JOIN split s ON d.doc_id = s.doc_id
LEFT JOIN counted g ON d.doc_id = g.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATE = f"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lowered("text")}, {_WORDS}) AS words
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_starts AS (
    SELECT item, words, least({WINDOW}, len(words)) AS size,
           unnest(range(1, CAST(len(words) - least({WINDOW}, len(words)) + 2 AS BIGINT))) AS s
    FROM item_words WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item, size, array_to_string(words[s : s + size - 1], ' ') AS w FROM item_starts
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_lowered("text")}, {_WORDS}), []) AS words FROM documents
), doc_starts AS (
    SELECT doc_id, words, size, unnest(range(1, CAST(len(words) - size + 2 AS BIGINT))) AS s
    FROM doc_words, (SELECT DISTINCT size FROM windows) sizes WHERE len(words) >= size
), found AS (
    SELECT d.doc_id, d.s, d.size, w.item
    FROM (SELECT doc_id, s, size, array_to_string(words[s : s + size - 1], ' ') AS w FROM doc_starts) d
    JOIN windows w ON d.size = w.size AND d.w = w.w
), hit AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS spot FROM (SELECT DISTINCT doc_id, s, size FROM found)) GROUP BY doc_id
), owners AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(o.n_items, 0) AS n_items,
       sha256(coalesce(o.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.words) AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN owners o ON d.doc_id = o.doc_id
"""


def _rule_case(part: str) -> str:
    rules = sorted(URL_RULES, key=lambda r: (len(r.name), r.name), reverse=True)
    whens = " ".join(
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN '{getattr(r, part)}'" for r in rules
    )
    return f"CASE {whens} END"


def _level(depth: int) -> str:
    """The common table expressions that work one level of the template tree."""
    return f"""
), at{depth} AS (
    SELECT *, array_to_string(template[1:{depth}], '/') AS node,
           CASE WHEN len(template) > {depth} THEN template[{depth + 1}] END AS child
    FROM shapes{depth}
), children{depth} AS (
    SELECT host, node, child, sum(urls) AS urls, sum(blocked) AS blocked, sum(labelled) AS labelled
    FROM at{depth} WHERE child IS NOT NULL GROUP BY host, node, child
), parents{depth} AS (
    SELECT host, node, sum(urls) AS all_urls, count(*) AS different,
           sum(CASE WHEN labelled > 0 THEN 1 ELSE 0 END) AS with_labels, sum(blocked) AS all_blocked, sum(labelled) AS all_labelled
    FROM children{depth} GROUP BY host, node
), rates{depth} AS (
    SELECT c.*, p.all_urls, p.different, p.with_labels,
           CASE WHEN c.labelled > 0 THEN c.blocked::DOUBLE / c.labelled END AS rate,
           CASE WHEN p.all_labelled > 0 THEN p.all_blocked::DOUBLE / p.all_labelled END AS pooled
    FROM children{depth} c JOIN parents{depth} p ON c.host = p.host AND c.node = p.node
), decided{depth} AS (
    SELECT host, node, child,
           CASE WHEN all_urls >= {urls.VARIABLE_LEAST} AND different >= {urls.VARIABLE_SHARE} * all_urls
                  OR coalesce(labelled > 0 AND with_labels > 1 AND abs(rate - pooled) <= {urls.Z} * sqrt(pooled * (1 - pooled) / labelled), FALSE)
                THEN '{urls.WILD}' ELSE child END AS becomes
    FROM rates{depth}
), shapes{depth + 1} AS (
    SELECT a.host, a.segments, a.urls, a.blocked, a.labelled,
           CASE WHEN d.becomes IS NULL THEN a.template
                ELSE list_concat(list_concat(a.template[1:{depth}], [d.becomes]), a.template[{depth + 2}:]) END AS template
    FROM at{depth} a LEFT JOIN decided{depth} d ON a.host = d.host AND a.node = d.node AND a.child = d.child"""


URL_FILTER = f"""
WITH behind AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, {_lowered("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM behind
), ruled AS (
    SELECT page_id, host, path, {_rule_case("name")} AS rule, {_rule_case("verdict")} AS ruled,
           string_split(regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '#', 'g'), '/') AS all_segments
    FROM parts
), cut AS (
    SELECT page_id, host, path, rule, ruled,
           CASE WHEN len(all_segments) > {urls.DEPTH}
                THEN list_concat(all_segments[1:{urls.DEPTH}], [array_to_string(all_segments[{urls.DEPTH + 1}:], '/')])
                ELSE all_segments END AS segments
    FROM ruled
), shapes0 AS (
    SELECT host, segments, count(*) AS urls, sum(CASE WHEN ruled = 'block' THEN 1 ELSE 0 END) AS blocked,
           count(ruled) AS labelled, segments AS template
    FROM cut GROUP BY host, segments{"".join(_level(d) for d in range(urls.DEPTH + 1))}
), named AS (
    SELECT host, segments, blocked, labelled, array_to_string(template, '/') AS template FROM shapes{urls.DEPTH + 1}
), totals AS (
    SELECT host, template,
           (sum(blocked) + {urls.SMOOTHING / 2})::DOUBLE / (sum(labelled) + {urls.SMOOTHING})::DOUBLE AS block_rate
    FROM named GROUP BY host, template
)
SELECT c.page_id, c.host, c.path, c.rule,
       coalesce(c.ruled, CASE WHEN t.block_rate >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       n.template, t.block_rate
FROM cut c JOIN named n ON c.host = n.host AND c.segments = n.segments
JOIN totals t ON n.host = t.host AND n.template = t.template
"""

_DRAWS = ", ".join(f"CAST('0x' || substr(digest, {1 + 8 * k}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))

FILL_MIDDLE = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS digest,
           regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n, {_DRAWS} FROM d
), cut AS (
    SELECT doc_id, text, units, n,
           least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:low], '') AS prefix,
           array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

_BEHIND = ", ".join(
    f"CASE WHEN i + {k - 1} <= len(words) THEN array_to_string(words[i:i + {k - 1}], ' ') END" for k in range(1, collocations.MAX_WORDS + 1)
)

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({_lowered("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), totals AS (
    SELECT lang, CAST(count(*) AS BIGINT) AS n FROM places GROUP BY lang
), phrases AS (
    SELECT lang, unnest([{_BEHIND}]) AS phrase, unnest(range(1, {collocations.MAX_WORDS + 1})) AS k FROM places
), f AS (
    SELECT lang, phrase, k, CAST(count(*) AS BIGINT) AS n FROM phrases WHERE phrase IS NOT NULL
    GROUP BY lang, phrase, k HAVING count(*) >= {collocations.LEAST_COUNT}
), candidates AS (
    SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1
), cuts AS (
    SELECT lang, phrase, k, a, words, unnest(range(1, k)) AS cut FROM candidates
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r,
           (CAST({collocations.SCALE} AS HUGEINT) * c.a * c.a) // (CAST(x.n AS HUGEINT) * y.n) AS score
    FROM cuts c JOIN f x ON c.lang = x.lang AND x.phrase = array_to_string(c.words[1:c.cut], ' ')
    JOIN f y ON c.lang = y.lang AND y.phrase = array_to_string(c.words[c.cut + 1:], ' ')
), weakest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored
), inside AS (
    SELECT lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase, a
    FROM candidates WHERE k = 3
), held AS (
    SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase
), ranked AS (
    SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank,
           w.phrase, w.a, w.l, w.r, w.score
    FROM weakest w LEFT JOIN held h ON w.lang = h.lang AND w.phrase = h.phrase
    WHERE w.place = 1 AND (h.most IS NULL OR 100 * h.most < {collocations.COVERED_PERCENT} * w.a)
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON r.lang = t.lang WHERE r.rank <= {collocations.TOP}
"""


def oracle_sql() -> dict[str, str]:
    """For each query that SQL can express, the SQL over the same tables."""
    return {
        "op3_warc": WARC,
        "op4_line_dedup": LINE_DEDUP,
        "op5_decontaminate": DECONTAMINATE,
        "op10_url_filter": URL_FILTER,
        "op11_fill_middle": FILL_MIDDLE,
        "op12_collocations": COLLOCATIONS,
    }
