"""DuckDB text of the stand-in tables, prepended as CTEs to oracle queries.

These are the same rules as ``tablefit.sources.standins`` written in DuckDB's
dialect; a query refers to ``blocks`` / ``clients`` / ``blocks_split`` /
``clients_split`` by name and gets only the CTEs it uses.
"""

from __future__ import annotations

import re


def hx(tag: str | None = None, key: str = "o_orderkey") -> str:
    inner = f"{key}::VARCHAR" if tag is None else f"{key}::VARCHAR || ':{tag}'"
    return f"('0x' || substr(md5({inner}), 1, 8))::BIGINT"


def _blocks() -> str:
    return (
        "blocks_l AS (SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n_lines, "
        "sum(l_extendedprice) AS ext FROM lineitem GROUP BY l_orderkey),\n"
        "blocks AS (SELECT o_orderkey AS block_id, o_totalprice AS total_value, c_acctbal AS balance, "
        "l.qty AS total_qty, l.n_lines AS lines, l.ext AS ext_price, c_mktsegment AS category, "
        "o_orderstatus AS status, o_orderpriority AS priority, "
        "l.qty / nullif(l.n_lines, 0) AS qty_per_line, l.ext / nullif(l.qty, 0) AS price_per_qty, "
        "o_totalprice / nullif(l.n_lines, 0) AS value_per_line "
        "FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN blocks_l l ON l.l_orderkey = o_orderkey)"
    )


def _clients() -> str:
    cols = [
        "o_orderkey AS id",
        "c_acctbal AS limit_bal",
        f"CAST({hx('sex')} % 2 + 1 AS INTEGER) AS sex",
        f"CAST({hx('edu')} % 7 AS INTEGER) AS education",
        f"CAST({hx('mar')} % 4 AS INTEGER) AS marriage",
        f"CAST(18 + {hx('age')} % 52 AS INTEGER) AS age",
    ]
    cols += [f"CAST({hx(f'pay{i}')} % 11 - 2 AS INTEGER) AS pay_{i}" for i in range(1, 7)]
    cols += [
        f"CAST(CASE WHEN {hx(f'zero{i}')} % 10 = 0 THEN 0 "
        f"ELSE {hx('bill')} % 100000 + {hx(f'bill{i}')} % 20000 END AS INTEGER) AS bill_amt{i}"
        for i in range(1, 7)
    ]
    cols += [f"CAST({hx(f'amt{i}')} % 5000 AS INTEGER) AS pay_amt{i}" for i in range(1, 7)]
    cols.append(
        f"CAST(CASE WHEN (({hx('pay1')} % 11 - 2) >= 3 AND {hx('l')} % 10 < 7) OR {hx('l')} % 10 = 9 "
        "THEN 1 ELSE 0 END AS INTEGER) AS label"
    )
    return ("clients AS (SELECT " + ", ".join(cols)
            + " FROM orders JOIN customer ON o_custkey = c_custkey)")


def _split(name: str, table: str, key: str) -> str:
    return f"{name} AS (SELECT *, CAST(({hx(None, key)} * 100) // 4294967296 AS INTEGER) AS bucket FROM {table})"


def _clients_prep() -> str:
    pays = ", ".join(f"CASE WHEN pay_{i} < 0 THEN 0 ELSE pay_{i} END AS pay_{i}" for i in range(1, 7))
    return ("clients_prep AS (SELECT * REPLACE (CASE WHEN education > 3 THEN 0 ELSE education END AS education, "
            f"CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage, {pays}) FROM clients)")


_CTES = [
    ("blocks", _blocks, ()),
    ("clients", _clients, ()),
    ("clients_prep", _clients_prep, ("clients",)),
    ("blocks_split", lambda: _split("blocks_split", "blocks", "block_id"), ("blocks",)),
    ("clients_split", lambda: _split("clients_split", "clients_prep", "id"), ("clients_prep",)),
]


def with_standins(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the stand-in tables it mentions."""
    needed: set[str] = set()
    for name, _, deps in reversed(_CTES):
        if re.search(rf"\b{name}\b", sql) or name in needed:
            needed.add(name)
            needed.update(deps)
    parts = [make() for name, make, _ in _CTES if name in needed]
    if not parts:
        return sql
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + body
