"""Pieces of SQL that the queries' equivalents share."""

from quern.operators.dedup import bands_for

#: White space, as a class of RE2.
BL = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{BL}+|{BL}+\z', '', 'g')"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{BL}+', ' ', 'g'))"


def pieces(x: str) -> str:
    """The pieces between white space."""
    return rf"list_filter(string_split_regex({x}, '{BL}+'), lambda w: w <> '')"


def gpt2_pieces(x: str) -> str:
    """The pieces of GPT-2's split pattern. A mark before the last blank of each run stands for the pattern's look-ahead."""
    marked = rf"regexp_replace(coalesce({x}, ''), '([\s\x{{85}}\p{{Z}}])([^\s\x{{85}}\p{{Z}}])', chr(57344) || '\1\2', 'g')"
    pattern = r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\x{85}\p{Z}\p{L}\p{N}\x{E000}]+|[\s\x{85}\p{Z}]+"
    return f"regexp_extract_all({marked}, '{pattern}')"


def clean(x: str) -> str:
    # fixed values: the cleaning patterns
    url = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
    t = f"regexp_replace({x}, '{url}', '', 'g')"
    t = rf"regexp_replace(regexp_replace({t}, '```[\s\S]*?```', '', 'g'), '`[^`]*`', '', 'g')"
    t = rf"regexp_replace({t}, '[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x{{9f}}]', '', 'g')"
    return collapse(t)


def message(x: str) -> str:
    t = collapse(f"coalesce({x}, '')")
    # fixed values: the marks that a template's text may hold
    for p in (r"(?is)<\|im_start\|>.*?<\|im_end\|>", "(?i)### Instruction:", "(?i)### Response:", r"(?i)Human:\s*", r"(?i)Assistant:\s*"):
        t = f"regexp_replace({t}, '{p}', '', 'g')"
    return strip(t)


def smart(x: str) -> str:
    w = rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"
    return rf"""(CASE WHEN {x} IS NULL OR len({strip(x)}) = 0 THEN 0 ELSE greatest(1, floor(
      len({x})::DOUBLE / 4.0::DOUBLE
        * (1.0::DOUBLE + greatest(0.0::DOUBLE, (CASE WHEN len({w}) > 0 THEN len(array_to_string({w}, ''))::DOUBLE / len({w}) ELSE 5.0::DOUBLE END) - 5.0::DOUBLE) * 0.02::DOUBLE)
        * least(1.2::DOUBLE, 0.8::DOUBLE + len(list_distinct(regexp_extract_all(lower({x}), '(?s).')))::DOUBLE / 100.0::DOUBLE)
      + len(regexp_extract_all({x}, '[.!?;:,]'))::DOUBLE * 0.5::DOUBLE
      + len(list_filter({w}, lambda y: regexp_full_match(y, '\p{{Nd}}+')))::DOUBLE * 0.3::DOUBLE
      - greatest(0, len(regexp_extract_all({x}, '{BL}+')) - len({pieces(x)}))::DOUBLE * 0.1::DOUBLE)) END)::BIGINT"""


def near_lost(shingled: str, threshold: float, permutations: int = 128) -> str:
    """Common table expressions up to ``lost(id)``: the documents of ``shingled`` (a query of ``id, x``) that share a band with an earlier kept one."""
    bands, rows = bands_for(threshold, permutations)
    number = lambda x: f"('0x' || substr(md5({x}), 1, 7))::BIGINT"
    return f"""perm AS (SELECT range AS i, {number("'a' || range")} + 1 AS a, {number("'b' || range")} AS b FROM range({bands * rows})),
    hashed AS (SELECT id, list_transform(x, lambda t: {number("t")}) AS h FROM ({shingled}) WHERE len(x) > 0),
    minima AS (SELECT id, i, list_min(list_transform(h, lambda v: (a * v + b) % 2147483647)) AS m FROM hashed, perm),
    band AS (SELECT id, i // {rows} AS no, string_agg(m, ',' ORDER BY i) AS key FROM minima GROUP BY 1, 2),
    edge AS (SELECT DISTINCT x.id AS earlier, y.id AS later FROM band x JOIN band y ON x.no = y.no AND x.key = y.key AND x.id < y.id),
    node AS (SELECT earlier AS id FROM edge UNION SELECT later FROM edge),
    state AS (SELECT 0 AS step, id, CASE WHEN id IN (SELECT later FROM edge) THEN 0 ELSE 1 END AS s FROM node
      UNION ALL SELECT r.step + 1, r.id, CASE WHEN r.s <> 0 THEN r.s WHEN bool_or(p.s = 1) THEN 2 WHEN bool_and(p.s = 2) THEN 1 ELSE 0 END
      FROM state r LEFT JOIN edge e ON e.later = r.id LEFT JOIN state p ON p.id = e.earlier WHERE (SELECT count(*) FROM state WHERE s = 0) > 0 GROUP BY r.step, r.id, r.s),
    lost AS (SELECT id FROM state WHERE s = 2 AND step = (SELECT max(step) FROM state))"""
