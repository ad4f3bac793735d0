"""Independent SQL statements for the plans, in DuckDB's dialect.

A statement names what it reads as ``{name}``: a supplied table, a source view
or another statement.  ``statements`` expands these to common table expressions
and writes the result in edge format (see ``stratamart.edge``).
"""

from __future__ import annotations

import re
from functools import lru_cache

from oracles import coupons, helpers, logistics, product, realtime, refund, shop, traffic
from stratamart.sources.supplied import RAW, VIEWS

AS_OF, LOG_AS_OF = "DATE '2001-08-01'", "DATE '2024-01-30'"

RAW_COLUMNS = {
    "region": "r_regionkey INT, r_name VARCHAR",
    "nation": "n_nationkey INT, n_name VARCHAR, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text VARCHAR",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
}

SQL: dict[str, str] = {}
for _area in (shop, product, traffic, logistics, coupons, refund, realtime, helpers):
    SQL.update(_area.SQL)


def _rates(text: str) -> str:
    """``RATE(x, y, k)``: x / y half up to k digits, in whole thousandths on 128-bit integers."""
    while (begin := text.find("RATE(")) >= 0:
        depth, parts, last = 0, [], begin + 5
        for end in range(begin + 4, len(text)):
            depth += (text[end] == "(") - (text[end] == ")")
            if text[end] == "," and depth == 1 or depth == 0:
                parts.append(text[last:end])
                last = end + 1
            if depth == 0:
                break
        n, d = (f"CAST(CAST({x} AS DECIMAL(30,3)) * 1000 AS HUGEINT)" for x in parts[:2])
        scale = 10 ** int(parts[2])
        text = f"{text[:begin]}(CAST((2 * {scale} * {n} + {d}) // (2 * {d}) AS DOUBLE) / {scale}){text[end + 1:]}"
    return text


def _text(name: str, as_of: str = AS_OF) -> str:
    text = SQL.get(name) or VIEWS[name]
    text = _rates(text)
    text = re.sub(r"EPOCH_MS\((CAST\(\w+ AS TIMESTAMP\))\)", r"(epoch_us(\1) // 1000)", text)
    text = text.replace("JSON_TEXT(", "json_extract_string(")
    return text.replace(":log_as_of", LOG_AS_OF).replace(":as_of", as_of)


def _needs(name: str, seen: dict[str, None]) -> None:
    if name in RAW or name in seen:
        return
    for other in re.findall(r"\{([a-z]\w*)\}", _text(name)):
        _needs(other, seen)
    seen[name] = None


def expanded(name: str, as_of: str = AS_OF) -> str:
    order: dict[str, None] = {}
    _needs(name, order)
    ctes = ",\n".join(f"{n} AS ({re.sub(r'[{]([a-z]\w*)[}]', r'\1', _text(n, as_of)).strip()})" for n in order)
    return f"WITH {ctes}\n"


def _edge(column: str, kind: str) -> str:
    quoted = f'"{column}"'
    if kind == "DATE":
        return f"strftime({quoted}, '%Y-%m-%d') AS {quoted}"
    if kind.startswith("TIMESTAMP"):
        return f"strftime({quoted}, '%Y-%m-%d %H:%M:%S') AS {quoted}"
    if kind.startswith("DECIMAL") or kind == "FLOAT":
        return f"CAST({quoted} AS DOUBLE) AS {quoted}"
    if kind in ("TINYINT", "SMALLINT", "INTEGER", "HUGEINT", "UBIGINT", "UINTEGER", "UHUGEINT"):
        return f"CAST({quoted} AS BIGINT) AS {quoted}"
    return quoted


@lru_cache
def statements(days: tuple[tuple[str, str], ...] = ()) -> dict[str, str]:
    """One statement per name; ``days`` gives some their own business date."""
    import duckdb

    con = duckdb.connect()
    for table, columns in RAW_COLUMNS.items():
        con.execute(f"CREATE TABLE {table} ({columns})")
    out = {}
    for name in SQL:
        head = expanded(name, f"DATE '{dict(days)[name]}'" if name in dict(days) else AS_OF)
        kinds = con.execute(f"DESCRIBE {head}SELECT * FROM {name}").fetchall()
        out[name] = f"{head}SELECT {', '.join(_edge(c[0], c[1]) for c in kinds)} FROM {name}"
    con.close()
    return out
