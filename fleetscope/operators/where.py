"""A user's predicate, given as text with named parameters, as a filter (F13).

The text is one Spark SQL condition over the columns of the frame, e.g.
``speed_kmh BETWEEN :low AND :high AND status = :status``.  Parameters are
bound values, never pasted into the text, so after constant folding the
comparisons reach the scan like any literal filter.  The text has to be one
whole expression (a second statement or a closing bracket too many is a parse
error) over this frame alone: queries inside it are refused.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quoted text, quoted names and comments, in which nothing is a marker or a keyword.
_QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/"
_PIECES = re.compile(rf"(?P<quoted>{_QUOTED})|(?P<cast>::)|:(?P<marker>[A-Za-z_]\w*)|(?P<word>[A-Za-z_]\w*)", re.S)
# Keywords that start or hold a query, or need more rows than one.
_REFUSED = {"select", "values", "table", "with", "over"}


class BadPredicate(ValueError):
    """A predicate that is not one condition over the frame's columns and the given parameters."""


def where(df: DataFrame, text: str, **params) -> DataFrame:
    """The rows of ``df`` for which the condition is true (NULL is not).

    A parameter is a number, text, boolean, date, datetime or None, and every
    one given has to be used.  A datetime without zone is a timestamp without
    zone, as the telemetry has them.  Raises ``BadPredicate`` for text that is
    no single condition, unknown columns or functions, conditions that are not
    boolean, missing or unused parameters, and queries inside the text.
    """
    used: set[str] = set()

    def piece(m: re.Match) -> str:
        if name := m["marker"]:
            used.add(name)
            return f"CAST(:{name} AS TIMESTAMP_NTZ)" if _zoneless(params.get(name)) else f":{name}"
        if m["word"] and m["word"].lower() in _REFUSED:
            raise BadPredicate(f"{m['word'].upper()} is not allowed in a predicate (quote a column of that name with `)")
        return m[0]

    bound = _PIECES.sub(piece, text)
    if missing := used - set(params):
        raise BadPredicate(f"no value for {', '.join(sorted(missing))}")
    if unused := set(params) - used:
        raise BadPredicate(f"the predicate does not use {', '.join(sorted(unused))}")
    args = {k: v.isoformat(" ") if _zoneless(v) else v for k, v in params.items()}
    try:
        _one_expression(df, _PIECES.sub(lambda m: "NULL" if m["marker"] else m[0], text))
        kind = _sql(df, f"SELECT (\n{bound}\n) AS condition FROM {{frame}}", args).schema["condition"].dataType
        if not isinstance(kind, T.BooleanType):
            raise BadPredicate(f"the predicate is of type {kind.simpleString()}, not boolean")
        # the alias is needed: in ``t WHERE (true)`` WHERE would be read as one
        return _sql(df, f"SELECT * FROM {{frame}} AS frame WHERE (\n{bound}\n)", args)
    except (AnalysisException, ParseException) as e:
        raise BadPredicate(str(e).split("\n", 1)[0]) from e


def _one_expression(df: DataFrame, text: str) -> None:
    """Parse the text alone: the brackets that ``where`` puts around it cannot be closed from inside."""
    try:
        df.select(F.expr(text))
    except ParseException:
        raise
    except AnalysisException:
        pass  # names and types are judged with the parameters bound


def _zoneless(value) -> bool:
    return isinstance(value, datetime) and value.tzinfo is None


def _sql(df: DataFrame, statement: str, args: dict) -> DataFrame:
    # braces of the user's text are no fields of the statement
    plain = statement.replace("{", "{{").replace("}", "}}").replace("{{frame}}", "{frame}")
    return df.sparkSession.sql(plain, args=args, frame=df)
