"""Statement runner (C1) and script validator (Q3)."""

from __future__ import annotations

from typing import Any, Callable, Mapping, Sequence

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from dockhand.operators.quality import script_validator


def run_script(spark: SparkSession, sql: str | Sequence[str] | None = None,
               sql_generator: Callable[..., str | Sequence[str]] | None = None,
               generator_kwargs: Mapping[str, Any] | None = None,
               parameters: Mapping[str, Any] | Sequence[Any] | None = None,
               schema: str | None = None, validator: str | None = None,
               validator_name: str = "script", run_date: str | None = None) -> DataFrame:
    """Run statements in order and return the last result.

    ``sql`` (or ``sql_generator(**generator_kwargs)``) is one statement or a
    list; a missing script is an error.  ``parameters`` binds named (dict) or
    positional (list) markers in every statement.  ``schema`` is switched to
    first.  ``validator`` is a last statement whose first cell must be >= 1
    (Q3); its check row is returned instead.
    """
    if sql is None and sql_generator is not None:
        sql = sql_generator(**(generator_kwargs or {}))
    if sql is None or (not isinstance(sql, str) and not sql):
        raise ValueError("give sql or sql_generator")
    stmts = [sql] if isinstance(sql, str) else list(sql)
    if schema:
        spark.catalog.setCurrentDatabase(schema)
    args = dict(parameters) if isinstance(parameters, Mapping) else (list(parameters) if parameters else None)
    last = None
    for s in stmts:
        last = spark.sql(s, args=args) if args else spark.sql(s)
    if validator:
        res = spark.sql(validator, args=args) if args else spark.sql(validator)
        return script_validator(res, validator_name, run_date)
    return last


def run_script_text(spark: SparkSession, text: str, parameters: Mapping[str, Any] | None = None, schema: str | None = None,
                    on_error: str | None = None, validator: str | None = None, validator_name: str = "script",
                    run_date: str | None = None) -> DataFrame:
    """C1 for a script that is one text of several statements: run them in order, return the last result.

    The text becomes the body of a SQL scripting block, so Spark's own parser
    finds the statements (semicolons inside literals and comments included)
    and variables, conditions, loops and handlers may be used; a text that is
    a whole block already is run as it is.  ``on_error`` is a statement
    for an exit handler: when any statement fails, the rest is left out and its result is
    returned; without it the error is raised.  ``parameters`` binds named markers (Spark
    has no positional ones in scripts).  ``validator`` is as in ``run_script``, run after the script.
    """
    if not text or not text.strip():
        raise ValueError("give a script")
    if parameters is not None and not isinstance(parameters, Mapping):
        raise TypeError("a script takes named parameters (a dict)")
    if schema:
        spark.catalog.setCurrentDatabase(schema)
    args = dict(parameters) if parameters else None
    # a statement must be closed, an empty one is refused: only the parser knows whether the text closed its last
    whole = text.lstrip()[:5].upper() == "BEGIN"
    forms = [text.rstrip().rstrip(";")] if whole else [f"BEGIN\n{text}\n{close}END" for close in (";\n", "")]
    if on_error:
        # a handler is declared before all else, the text's own variables at the start of its own block
        handler = f"DECLARE EXIT HANDLER FOR SQLEXCEPTION BEGIN\n{on_error}\n;\nEND;"
        forms = [f"BEGIN\n{handler}\n{form};\nEND" for form in forms]
    last = None
    for k, form in enumerate(forms):
        try:
            last = spark.sql(form, args=args) if args else spark.sql(form)
            break
        except ParseException:  # raised before any statement runs
            if k + 1 == len(forms):
                raise
    if validator:
        res = spark.sql(validator, args=args) if args else spark.sql(validator)
        return script_validator(res, validator_name, run_date)
    return last
