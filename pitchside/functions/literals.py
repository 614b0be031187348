"""Read a field out of a cell that may hold a Python dict literal.

Rules (the modelled job evaluates the literal and calls ``.get(key, '')``):

* the cell is a dict literal and the key holds a string -> that string;
* the cell is a dict literal without the key -> ``''`` (the row is later dropped);
* anything else (not a literal, not a dict, key holding None or a non-string)
  -> the whole cell.

The JVM decides every dict, nested or not, that is made of plain tokens: strings without
escapes, None, True, False, plain numbers and brackets.  One match decides a dict of string keys that is at most
three levels deep: the pattern is the dict's grammar, and its group keeps the value that the key has last.  Any
other cell of plain tokens is rewritten to JSON (a marker
inside each string's opening quote keeps strings apart from other values) and parsed with
``from_json``; a closing element after it shows that nothing followed the dict.  All patterns loop
possessively or over single characters, which Java runs without recursion, so a cell may be of any length.

Other cells that could still be a dict to Python, those with an opening brace somewhere (escapes, tuples, trailing
commas, other number forms, line breaks or parentheses before the dict, junk), are left to one vectorised pandas UDF
with Python's literal parser.  They leave the plan for it: :func:`literal_columns` decides what it can and hands
out the cells that wait, and only rows with such cells reach :func:`decide`.  Where there are none, adaptive
execution drops that branch and no Python worker starts.
``pending`` columns say which rows those are, so a job can count them.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S

_PLAIN = (r"""^[ \t]*+\{(?:[{}\[\]:, \t]++|'[^'\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+"|None|True|False"""
          r"""|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?)*+\z""")
#: Control characters one by one: of single characters Java makes one table, and loops over a table are fast.
_CONTROL = "".join(rf"\x{c:02x}" for c in range(32))
_TEXT = rf"""(?:'[^'\\{_CONTROL}]*'|"[^"\\{_CONTROL}]*")"""
_SCALAR = rf"""(?:{_TEXT}|None|True|False|-?(?:0|[1-9][0-9]{{0,17}}+)(?:\.[0-9]{{1,99}}+)?)"""
_OPEN, _CLOSE = r"\{", r"\}"
_STRING = r"""(?s)(['"])((?:(?!\1).)*+)\1"""
#: Everything from the last hit up to the next keyword that stands outside strings.
_UP_TO = r"""\G((?:[^'"NTF]++|'[^']*+'|"[^"]*+")*+)"""
_MARK = "\u0001"
_END = "\u0002"
_OPTIONS = {"allowSingleQuotes": "true", "allowUnquotedControlChars": "true", "allowNonNumericNumbers": "false"}


def _make_decider():
    """Build the reference-semantics decision as a closure.

    The residual UDF ships this function to Python workers; a nested function
    is pickled by value, so workers need no import of this package (on a
    cluster the library need not be installed on executors)."""
    import ast

    def literal_field_py(cell, key):
        """Reference semantics on one cell (residual UDF and tests)."""
        if cell is None:
            return None
        try:
            value = ast.literal_eval(cell).get(key, "")
        except Exception:
            return cell
        return value if isinstance(value, str) else cell

    return literal_field_py


literal_field_py = _make_decider()


def _residual_udf(keys: tuple[str, ...]):
    """One vectorised UDF for all cell columns of a row: the reference decision for each non-null cell."""
    schema = ", ".join(f"v{i} string" for i in range(len(keys)))
    decide = _make_decider()

    @F.pandas_udf(schema)
    def residual(*cols: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            f"v{i}": [None if c is None else decide(c, k) for c in col]
            for i, (col, k) in enumerate(zip(cols, keys))
        })

    return residual


def _as_json(cell: Column) -> Column:
    """The dict as JSON text, strings marked; null where it is not made of plain tokens."""
    text = F.regexp_replace(cell, _STRING, "$1" + _MARK + "$2$1")
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, _UP_TO.replace("NTF", word[0]) + word, "$1" + json)
    return F.when(cell.rlike(_PLAIN), F.concat(F.lit("["), text, F.lit(f", '{_END}']")))


def _list_of(item: str, opening: str, closing: str) -> str:
    return rf"{opening}[ \t]*+(?:{item}[ \t]*+(?:,[ \t]*+(?!{closing})|(?={closing})))*+{closing}"


def _dict_with(key: str, levels: int = 3) -> str:
    """The pattern of a whole cell that is a dict literal; its group is the value of the last ``key``, if there is one."""
    value = _SCALAR
    for _ in range(levels - 1):
        item = rf"{_TEXT}[ \t]*+:[ \t]*+{value}"
        value = f"(?:{_SCALAR}|{_list_of(item, _OPEN, _CLOSE)}|{_list_of(value, r'\[', r'\]')})"
    plain = not any(c == "\\" or c < " " for c in key)  # no string without escapes has another key
    names = [rf"{q}\Q{key}\E{q}" for q in ("'", '"') if plain and q not in key]
    item = rf"(?:(?:{'|'.join(names) or '(?!)'})[ \t]*+:[ \t]*+({value})|{_TEXT}[ \t]*+:[ \t]*+{value})"
    return rf"\A[ \t]*+{_list_of(item, _OPEN, _CLOSE)}[ \t]*+\z"


Specs = list[tuple[str, str, str]]


def literal_columns(df: DataFrame, specs: Specs) -> DataFrame:
    """Add two columns per ``(cell, key, out)``: ``out``, the raw (not yet canonicalised) value of ``key`` in the
    cell column ``cell`` as far as the JVM decides it, and ``<out>_cell``, the cell if Python has to, else null."""
    matched = df.withColumns({f"__{out}_match": F.when(F.col(cell).cast("string").contains("{"), F.regexp_replace(
        F.col(cell).cast("string"), _dict_with(key), _MARK + "$1")) for cell, key, out in specs})
    # a match leaves the mark and the value; its strings still have their quotes
    staged = matched.withColumns({f"__{out}_flat": F.expr(
        f"CASE WHEN NOT startswith(`__{out}_match`, {S.lit(_MARK)}) OR startswith(CAST({S.col(cell)} AS STRING), {S.lit(_MARK)}) THEN NULL "
        f"WHEN `__{out}_match` = {S.lit(_MARK)} THEN '' "
        f"WHEN substr(`__{out}_match`, 2, 1) IN ('\\'', '\"') THEN substr(`__{out}_match`, 3, length(`__{out}_match`) - 3) "
        f"ELSE CAST({S.col(cell)} AS STRING) END") for cell, _, out in specs})
    staged = staged.withColumns({f"__{out}_list": F.when(
        F.col(f"__{out}_flat").isNull() & F.col(f"__{out}_match").isNotNull(),
        F.from_json(_as_json(F.col(cell).cast("string")), "array<string>", _OPTIONS)) for cell, _, out in specs})
    # nothing but the closing element may follow the dict; its text now has double quotes and escapes
    staged = staged.withColumns({f"__{out}_dict": F.expr(
        f"CASE WHEN size(`__{out}_list`) = 2 AND `__{out}_list`[1] = {S.lit(_END)} THEN `__{out}_list`[0] END")
        for _, _, out in specs})
    decided = {}
    for cell, key, out in specs:
        s, parsed = F.col(cell).cast("string"), F.col(f"__{out}_dict")
        value = F.from_json(parsed, f"`{_MARK}{key}` string").getField(f"{_MARK}{key}")
        flat, may_be_dict = F.col(f"__{out}_flat"), F.col(f"__{out}_match").isNotNull()
        decided[out] = (F.when(s.isNull(), F.lit(None).cast("string"))
                        .when(~may_be_dict, s)
                        .when(flat.isNotNull(), flat)
                        .when(value.startswith(_MARK), F.substr(value, F.lit(2)))
                        .when(parsed.isNotNull() & ~F.array_contains(F.json_object_keys(parsed), F.lit(_MARK + key)), F.lit(""))
                        .when(parsed.isNotNull(), s))
        decided[f"{out}_cell"] = F.when(may_be_dict & flat.isNull() & parsed.isNull(), s)
    return staged.withColumns(decided).drop(*[f"__{o}_{x}" for _, _, o in specs for x in ("match", "flat", "list", "dict")])


def waiting(specs: Specs) -> Column:
    """Whether Python has to decide a cell of the row, after :func:`literal_columns`."""
    return F.coalesce(*[F.col(f"{out}_cell") for _, _, out in specs]).isNotNull()


def decide(df: DataFrame, specs: Specs, shared: bool = False) -> DataFrame:
    """Rows with cells that wait, their columns ``out`` decided by Python's parser.

    Each distinct combination of cells is decided once and joined back.  Of a merge join adaptive execution
    knows both sides' rows before it goes on: where no row waits it drops the join and with it the Python node.
    With ``shared`` the distinct cells are taken from whole rows, dealt by all columns: where ``df`` is an aggregate,
    no column is pruned from it for one side alone, so its shuffle is the same one on both sides and runs once.
    """
    cells = [f"{out}_cell" for _, _, out in specs]
    asked = (df.repartition(*[F.col(S.col(c)) for c in df.columns]) if shared else df).select(*[F.col(c).alias(f"__{c}") for c in cells]).distinct()
    res = _residual_udf(tuple(k for _, k, _ in specs))(*[F.col(f"__{c}") for c in cells])
    answered = asked.withColumns({f"__{out}_value": res[f"v{i}"] for i, (_, _, out) in enumerate(specs)})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cells])
    joined = df.join(answered.hint("merge"), same)
    return joined.select(*[F.coalesce(c, f"__{c}_value").alias(c) if c in {o for _, _, o in specs} else F.col(f"`{c}`") for c in df.columns])


def with_literal_fields(df: DataFrame, specs: Specs, pending: bool = False) -> DataFrame:
    """Add one column per ``(cell, key, out)``: the value of ``key`` in the cell column ``cell``, per the rules above.

    With ``pending`` also a boolean ``<out>_pending`` each: Python decided the cell.  Rows come in no order; ``df``
    is read once for the rows that the JVM decides and once for the others.
    """
    staged = literal_columns(df, specs)
    others = decide(staged.filter(waiting(specs)), specs)
    out = staged.filter(~waiting(specs)).unionByName(others)
    if pending:
        out = out.withColumns({f"{o}_pending": F.col(f"{o}_cell").isNotNull() for _, _, o in specs})
    return out.drop(*[f"{o}_cell" for _, _, o in specs])


def with_literal_field(df: DataFrame, cell: str, key: str, out: str) -> DataFrame:
    """Single-column form of :func:`with_literal_fields`."""
    return with_literal_fields(df, [(cell, key, out)])
