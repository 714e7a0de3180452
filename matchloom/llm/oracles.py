"""DuckDB SQL for the queries that SQL expresses: chat, WARC, URL filters, licenses and decontamination.

The others have none: scores of an automaton, classifier chains, robust scatter, order sketches and byte-pair merges.
"""

from __future__ import annotations

import re

from . import licenses
from .url_filters import Rule


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chat(probe: str) -> str:
    """Each turn adds both marks, two line ends and its escaped role and text to the output."""
    escaped = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
    return f"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, {_quoted(probe)} FROM range(2) r(n))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(24 + length(replace({escaped.format('role')}, chr(10), '\\n')) + length({escaped.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


#: SHA-1 comes as hexadecimal digits; five of them, 20 bits, are four digits of base32.
WARC = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error FROM f"""


def urls(rules: list[Rule]) -> str:
    """Decisions spread from ruled addresses along links, either way, until none is new."""
    host = lambda c: f"translate(regexp_extract({c}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = lambda c: f"regexp_extract({c}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

    def plain(c: str) -> str:
        kept = f"""array_to_string(list_filter(string_split(regexp_extract({c}, '(?s)^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|ref|fbclid|gclid)(=|$)')), '&')"""
        return f"CASE WHEN {host(c)} <> '' THEN regexp_replace({host(c)}, ':(80|443)$', '') || regexp_replace({path(c)}, '/+$', '') || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"

    cases = ""
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow"), reverse=True):
        cases += f" WHEN (host = {_quoted(r.host)} OR ends_with(host, {_quoted('.' + r.host)})) AND starts_with(path, {_quoted(r.path)}) THEN {_quoted(r.text)}"
    allowed = ", ".join(_quoted(r.text) for r in rules if r.verdict == "allow")
    tag = r"""regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0)"""
    canonical = rf"""regexp_extract({tag}, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)"""
    refresh = r"""regexp_extract(html, '(?is)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh\b[^>]*\burl\s*=\s*([^"''\s>]+)', 1)"""
    return f"""WITH RECURSIVE p AS (SELECT page_id, coalesce(url, '') AS url, {host("coalesce(url, '')")} AS host, {path("coalesce(url, '')")} AS path FROM pages),
r AS (SELECT page_id, host, path, {plain('url')} AS node, CASE{cases} END AS rule FROM p),
l AS (SELECT url, unnest([{canonical}, {refresh}]) AS target FROM pages),
e AS (SELECT {plain('url')} AS u, {plain('target')} AS v FROM l WHERE contains(target, '://')),
b AS (SELECT u, v FROM e WHERE u IS NOT NULL AND v IS NOT NULL UNION SELECT v, u FROM e WHERE u IS NOT NULL AND v IS NOT NULL),
s(node, allowed) AS (SELECT node, rule IN ({allowed}) FROM r WHERE rule IS NOT NULL AND node IS NOT NULL UNION SELECT b.v, s.allowed FROM s JOIN b ON b.u = s.node),
c AS (SELECT node, bool_or(allowed) AS allowed FROM s GROUP BY node)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({allowed}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN c.allowed THEN 'allow' WHEN NOT c.allowed THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN c USING (node)"""


def license_rules() -> str:
    """Ends of sentences become a control character; SQL's patterns can't look ahead."""
    parts: dict[str, str] = {}
    order: dict[str, str] = {}
    for k, sentence in licenses.SENTENCES.items():
        plain = [" ".join("".join(c if c.isalnum() else " " for c in s.lower()).split()) for s in re.split(r"[.!?:;]+(?=\s|$)|\n+", sentence)]
        plain = [s for s in plain if s]
        for i, s in enumerate(plain):
            parts.setdefault(s, k if len(plain) == 1 else f"{k}#{i}")
        order[k] = " ".join(parts[s] for s in plain)
    known = "MAP {" + ", ".join(f"{_quoted(s)}: {_quoted(k)}" for s, k in parts.items()) + "}"
    marked = r"regexp_replace(replace(coalesce(text, ''), chr(1), '_'), '[.!?:;]+([\t\n\x0B\f\r ]|$)', chr(1) || '\1', 'g')"
    ids = lambda c: f"list_filter(list_transform({c}, lambda x: k.known[trim(regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))]), lambda x: x IS NOT NULL)"
    chain = {r: " " + " ".join(order[i] for i in seq) + " " for r, _, seq in licenses.RULES}
    fits = lambda s: f"(contains(a, {_quoted(s)}) OR contains(b, {_quoted(s)}))"
    hits = []
    for r, _, _ in licenses.RULES:
        longer = [s for q, s in chain.items() if q != r and chain[r] in s and len(s) > len(chain[r])]
        hits.append(f"CASE WHEN {' AND NOT '.join(map(fits, [chain[r], *longer]))} THEN {_quoted(r)} END")
    names = "MAP {" + ", ".join(f"{_quoted(r)}: {_quoted(n)}" for r, n, _ in licenses.RULES) + "}"
    return rf"""WITH k AS (SELECT {known} AS known, {names} AS names),
m AS (SELECT doc_id, regexp_split_to_array({marked}, '\x01|\n+') AS lines, regexp_split_to_array({marked}, '\x01|\n[\t\n\x0B\f\r ]*\n') AS wrapped FROM documents),
i AS (SELECT doc_id, CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]'))) AS BIGINT) AS n_sentences, {ids('lines')} AS lines, {ids('wrapped')} AS wrapped, k.names FROM m, k),
c AS (SELECT *, ' ' || array_to_string(lines, ' ') || ' ' AS a, ' ' || array_to_string(wrapped, ' ') || ' ' AS b FROM i),
h AS (SELECT *, list_sort(list_filter([{', '.join(hits)}], lambda x: x IS NOT NULL)) AS found FROM c)
SELECT doc_id, n_sentences, array_to_string(CASE WHEN len(wrapped) > len(lines) THEN wrapped ELSE lines END, ',') AS sentence_ids,
  array_to_string(found, ',') AS matched_rules, array_to_string(list_sort(list_distinct(list_transform(found, lambda x: h.names[x]))), ',') AS licenses FROM h"""


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows are compared as texts, for each of the lengths that items' windows have.
DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
n AS (SELECT item, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
x AS (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM n),
win AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM x),
y AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win)),
o AS (SELECT r, i, k, s FROM (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM y) JOIN (SELECT DISTINCT k, s FROM win) USING (k, s)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM o) GROUP BY r),
item AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM o JOIN win USING (k, s) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""
