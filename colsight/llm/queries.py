"""The operators' registered queries, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colsight.llm import op1_decontaminate, op10_binary, op11_alignment, op12_repair, op13_links, op2_packing, op3_tokens, op4_suffix, op5_substring, op6_jaccard, op7_html, op8_language, op9_quality
from colsight.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": lambda s, d: op1_decontaminate.search(load(s, d, "documents"), load(s, d, "benchmark")),
    "op2_packing": lambda s, d: op2_packing.pack_documents(load(s, d, "documents")),
    "op3_tokens": lambda s, d: op3_tokens.count_tokens(load(s, d, "documents")),
    "op4_suffix": lambda s, d: op4_suffix.digest(load(s, d, "documents")),
    "op5_substring": lambda s, d: op5_substring.digest(load(s, d, "documents")),
    "op6_jaccard": lambda s, d: op6_jaccard.linked(load(s, d, "documents")),
    "op7_html": lambda s, d: op7_html.extract(load(s, d, "pages")),
    "op8_language": lambda s, d: op8_language.identify(load(s, d, "documents")),
    "op9_quality": lambda s, d: op9_quality.quality(load(s, d, "documents")),
    "op10_binary": lambda s, d: op10_binary.packed_rows(load(s, d, "documents")),
    "op11_alignment": lambda s, d: op11_alignment.align(load(s, d, "documents")),
    "op12_repair": lambda s, d: op12_repair.repair_damaged(load(s, d, "conversations")),
    "op13_links": lambda s, d: op13_links.judge(load(s, d, "pages")),
}

# --- SQL, apart from the operators' constants ---------------------------------------------------

_WORD = r"[^\x20\x09-\x0D]+"
_ROWS = f"rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _kept_sql(earlier: str) -> str:
    """Words under a 50-word window whose first occurrence `f` (doc_id, place) is earlier."""
    return f"""WITH {_ROWS},
    windows AS (SELECT rid, doc_id, i, list_slice(w, i, i + 49) AS g FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM rows)),
    later AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min((doc_id, i)) OVER (PARTITION BY g) AS f FROM windows) WHERE {earlier}),
    gone AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS place FROM later),
    words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM rows),
    kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS t FROM words ANTI JOIN gone USING (rid, place) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM rows LEFT JOIN kept USING (rid)"""


def _links_sql(rounds: int = 30) -> str:
    """Rules by their texts, then the rounds of both propagations written out, in whole numbers."""
    host = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hidden = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
    href = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''<>\s]+)"""
    rule = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%' THEN '{v}:{h}{p}'"
        for v, h, p in (
            ("allow", "www.example.com", "/en/"), ("block", "example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "com", "/"),
        )
    )
    moves = ", ".join(
        f"m{i + 1} AS MATERIALIZED (SELECT kind, dst AS host, sum(mass // 20 * 17 // degree)::BIGINT AS mass FROM m{i} JOIN roads USING (kind, host) GROUP BY ALL HAVING sum(mass // 20 * 17 // degree) > 0)"
        for i in range(rounds)
    )
    every = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(rounds + 1))
    return f"""WITH place AS (SELECT page_id, {host.format("url")} AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, html FROM (SELECT page_id, coalesce(url, '') AS url, html FROM pages)),
    told AS MATERIALIZED (SELECT *, CASE {rule} END AS r FROM place),
    share AS MATERIALIZED (SELECT host, 1000000000000 * count(*) FILTER (r LIKE 'allow%') // count(*) AS yes, 1000000000000 * count(*) FILTER (r LIKE 'block%') // count(*) AS no FROM told WHERE host <> '' GROUP BY 1),
    edge AS MATERIALIZED (SELECT DISTINCT host AS src, {host.format("':' || l")} AS dst FROM (SELECT host, unnest(regexp_extract_all(regexp_replace(html, '{hidden}', ' ', 'g'), '{href}', 1)) AS l FROM place WHERE host <> '')),
    road AS (SELECT 0 AS kind, src AS host, dst FROM edge WHERE src <> dst AND dst <> '' UNION ALL SELECT 1, dst, src FROM edge WHERE src <> dst AND dst <> ''),
    roads AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM road),
    m0 AS MATERIALIZED (SELECT 0 AS kind, host, yes AS mass FROM share WHERE yes > 0 UNION ALL SELECT 1, host, no FROM share WHERE no > 0), {moves},
    total AS (SELECT host, coalesce(sum(mass - mass // 20 * 17) FILTER (kind = 0), 0)::BIGINT AS trust, coalesce(sum(mass - mass // 20 * 17) FILTER (kind = 1), 0)::BIGINT AS distrust FROM ({every}) GROUP BY 1),
    judged AS (SELECT host, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust, rest - rest // 20 * 17 AS rest FROM (SELECT host, 1000000000000 - yes - no AS rest FROM share) LEFT JOIN total USING (host))
    SELECT page_id, host, path, substr(r, 7) AS rule, coalesce(substr(r, 1, 5), CASE WHEN distrust > 0 AND 100 * distrust::HUGEINT >= 50 * (trust + distrust + rest)::HUGEINT THEN 'block' ELSE 'allow' END) AS verdict, trust, distrust
    FROM told LEFT JOIN judged USING (host)"""


ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
    sizes AS (SELECT DISTINCT least(len(w), 5) AS m FROM b WHERE len(w) > 0),
    ds AS (SELECT DISTINCT doc_id, list_slice(w, i, i + m - 1) AS g FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes)),
    bs AS (SELECT DISTINCT item_id, list_slice(w, i, i + 4) AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
    size AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1),
    met AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (g) GROUP BY 1, 2)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM met JOIN size USING (item_id) WHERE 10 * n_shared >= 8 * n_item""",
    "op4_suffix": _kept_sql("f < (doc_id, i)"),
    "op5_substring": _kept_sql("f[1] < doc_id"),
    "op6_jaccard": f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
    size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM met JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * met.n >= 85 * (p.n + q.n - met.n)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN size USING (doc_id) JOIN least USING (doc_id)""",
    "op9_quality": f"""WITH {_ROWS},
    windows AS (SELECT rid, i, list_slice(w, i, i + 2) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM rows)),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
    again AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY 1),
    m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines, coalesce(n, 0) AS n_repeat_words FROM rows LEFT JOIN again USING (rid)),
    f AS (SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '([.]{{3}}|…)[\\x20\\x09-\\x0D]*$'))) AS dots,
        len(list_filter(lines, lambda x: regexp_matches(x, '(?s)^[\\x20\\x09-\\x0D]*([-*]\\x20.*[^\\x20\\x09-\\x0D]|•)'))) AS bullets FROM m),
    v AS (SELECT *, n_words < 50 AS b0, 2 * n_repeat_words > n_words AS b1, 10 * n_symbols > n_words AS b2, 2 * n_dup_lines > n_lines AS b3,
        word_chars < 3 * n_words AS b4, word_chars > 10 * n_words AS b5, 10 * dots > 3 * n_lines AS b6, 10 * bullets > 9 * n_lines AS b7 FROM f)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 OR b1 AS base_failed, NOT (b0 OR b1 OR b2 OR b3) AS kept,
    CAST(b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT + 64 * b6::INT + 128 * b7::INT AS BIGINT) AS failed FROM v""",
    "op13_links": _links_sql(),
}
