"""Pieces of plain SQL that several checks share."""

from __future__ import annotations

from collections.abc import Sequence

# Columns of the given tables with the type names the catalog shows for them.
COLUMNS = {
    "region": "r_regionkey INT64, r_name STRING",
    "nation": "n_nationkey INT64, n_name STRING, n_regionkey INT64",
    "customer": "c_custkey INT64, c_name STRING, c_nationkey INT64, c_acctbal FLOAT64, c_mktsegment STRING",
    "supplier": "s_suppkey INT64, s_name STRING, s_nationkey INT64, s_acctbal FLOAT64",
    "part": "p_partkey INT64, p_name STRING, p_brand STRING, p_type STRING, p_size INT64, p_retailprice FLOAT64",
    "orders": "o_orderkey INT64, o_custkey INT64, o_orderstatus STRING, o_totalprice FLOAT64, o_orderdate DATETIME, "
              "o_orderpriority STRING",
    "lineitem": "l_orderkey INT64, l_partkey INT64, l_suppkey INT64, l_linenumber INT64, l_quantity FLOAT64, "
                "l_extendedprice FLOAT64, l_discount FLOAT64, l_tax FLOAT64, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate DATETIME",
    "events": "event_id INT64, ts DATETIME, user_id INT64, event_type STRING, value FLOAT64, props STRING",
    "documents": "doc_id INT64, text STRING, lang STRING, source STRING, n_chars INT64",
    "embeddings": "vec_id INT64, embedding REPEATED_FLOAT64, label INT64",
    "pages": "page_id INT64, url STRING, html STRING",
    "benchmark": "item_id INT64, text STRING",
    "labels": "doc_id INT64, quality INT64, toxic INT64",
    "conversations": "conv_id INT64, turn INT64, role STRING, text STRING",
}

SQL_CODES = {"INT64": -5, "STRING": 12, "FLOAT64": 8, "DATETIME": 93, "REPEATED FLOAT64": 12}
CLASSES = {
    "INT64": "INTEGER", "STRING": "STRING", "FLOAT64": "REAL", "DATETIME": "DATETIME", "REPEATED FLOAT64": "Collection(REAL)",
}


def columns(table: str) -> list[tuple[str, str]]:
    pairs = [c.strip().split(" ") for c in COLUMNS[table].split(",")]
    return [(name, kind.replace("_", " ")) for name, kind in pairs]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def catalog_sql(extra: str = "", tables: Sequence[str] = tuple(COLUMNS)) -> str:
    """Every top-level column of the given tables with counts taken from the data."""
    parts = []
    for table in tables:
        for i, (name, kind) in enumerate(columns(table)):
            items = f"coalesce(sum(len({name})), 0)::BIGINT" if kind.startswith("REPEATED") else "0::BIGINT"
            most = f"coalesce(max(len({name})), 0)::BIGINT" if kind.startswith("REPEATED") else "0::BIGINT"
            parts.append(
                f"SELECT 'main' AS schema_name, '{table}' AS table_name, '{name}' AS column_name, '{name}' AS field_path, "
                f"{i} AS ordinal, '{kind}' AS source_type, {SQL_CODES[kind]} AS sql_code, '{CLASSES[kind]}' AS defined_by, "
                f"count(*) AS row_count, count({name}) AS value_count, count(*) - count({name}) AS null_count, "
                f"{items} AS item_count, {most} AS max_items FROM {table}"
            )
    return " UNION ALL ".join(parts) + extra


def values(rows: Sequence[Sequence], names: str) -> str:
    def show(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        return text(v) if isinstance(v, str) else repr(v)

    body = ", ".join("(" + ", ".join(show(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({names}))"


# The draws of the hashing functions, in plain SQL.

def hash_hex(label: str, value: str, draw: int) -> str:
    return f"md5(concat_ws('|', '42', {text(label)}, ({value})::VARCHAR, '{draw}'))"


def hash_number(label: str, value: str, draw: int) -> str:
    return f"('0x' || substr({hash_hex(label, value, draw)}, 1, 8))::BIGINT"


def hash_range(label: str, value: str, draw: int, low: int, high: int) -> str:
    return f"({low} + {hash_number(label, value, draw)} % {high - low + 1})"


def hash_letters(label: str, value: str, low: int, high: int) -> str:
    raw = f"{hash_hex(label, value, 1)} || {hash_hex(label, value, 2)}"
    return f"substr(translate({raw}, '0123456789abcdef', 'abcdefghijklmnop'), 1, {hash_range(label, value, 0, low, high)})"


def hash_pick(label: str, value: str, items: Sequence[str], draw: int = 0) -> str:
    listed = ", ".join(text(i) for i in items)
    return f"([{listed}])[{hash_number(label, value, draw)} % {len(items)} + 1]"


def digits(label: str, value: str, draw: int, length: int) -> str:
    return f"lpad(({hash_number(label, value, draw)} % {10**length})::VARCHAR, {length}, '0')"


def check_digit(body: str) -> str:
    """A 15-digit text with its mod-10 check digit."""
    doubled = "2 * substr(b, i, 1)::INT - CASE WHEN substr(b, i, 1)::INT > 4 THEN 9 ELSE 0 END"
    total = f"list_sum([CASE WHEN i % 2 = 1 THEN {doubled} ELSE substr(b, i, 1)::INT END FOR i IN range(1, 16)])"
    return f"(SELECT b || ((10 - {total} % 10) % 10)::INT::VARCHAR FROM (SELECT {body} AS b))"


def wide_number(label: str, value: str, draw: int | str) -> str:
    """A whole number of 60 bits."""
    return f"('0x' || substr({hash_hex(label, value, draw)}, 1, 15))::BIGINT"


def spelled(number: str, letters: str, low: int, high: int) -> str:
    """The text of a number: ``low`` to ``high`` letters, shorter texts first, the last letter moving fastest."""
    size, first, cases = len(letters), 0, []
    for length in range(low, high + 1):
        places = [f"substr('{letters}', ((({number}) - {first}) // {size**k} % {size} + 1)::INT, 1)" for k in range(length - 1, -1, -1)]
        cases.append((first + size**length, " || ".join(places)))
        first += size**length
    return "CASE " + " ".join(f"WHEN ({number}) < {end} THEN {text}" for end, text in cases) + " END"


def permuted(number: str, size: int, label: str) -> str:
    """The keyed permutation for a size that is the product of its two bases."""
    from tablewright.functions.permuting import ROUNDS, bases

    a, b = bases(size)
    if a * b != size:
        raise ValueError("this check knows no walks")
    hashed = lambda x: f"('0x' || substr(md5(concat_ws('|', '42', {text(label)}, concat_ws('|', {x}::VARCHAR, t.h::VARCHAR), '0')), 1, 15))::BIGINT"
    turns = ", ".join(f"{{'h': {i}::BIGINT, 'l': 0::BIGINT}}" for i in range(1, ROUNDS + 1))
    pair = (
        f"list_reduce(list_concat([{{'h': (({number}) // {b})::BIGINT, 'l': (({number}) % {b})::BIGINT}}], [{turns}]), lambda s, t: CASE WHEN t.h % 2 = 1 "
        f"THEN {{'h': (s.h + {hashed('s.l')} % {a}) % {a}, 'l': s.l}} ELSE {{'h': s.h, 'l': (s.l + {hashed('s.h')} % {b}) % {b}}} END)"
    )
    return f"(({pair}).h * {b} + ({pair}).l)"
