"""Which columns a rule's expression uses, and whether they exist at a lower level."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.functions.levels import level_number

# Words of Spark SQL expressions that are not column names when no bracket follows.
KEYWORDS = tuple(
    """
    ALL AND ANTI ANY ARRAY AS ASC BETWEEN BIGINT BINARY BOOLEAN BOTH BY BYTE CASE CAST
    CHAR CHARACTER COLLATE CURRENT CURRENT_DATE CURRENT_TIME CURRENT_TIMESTAMP CURRENT_USER DATE
    DEC DECIMAL DESC DISTINCT DIV DOUBLE ELSE END ESCAPE EXISTS EXTRACT FALSE FILTER
    FIRST FLOAT FOLLOWING FOR FROM GROUP GROUPS IGNORE ILIKE IN INT INTEGER INTERVAL INTO IS LAST
    LEADING LIKE LONG MAP NOT NULL NULLS NUMERIC OF ON OR ORDER OVER OVERLAY PARTITION PLACING
    POSITION PRECEDING RANGE REAL REGEXP RESPECT RLIKE ROW ROWS SELECT SHORT SMALLINT SOME STRING
    STRUCT SUBSTRING THEN TIMESTAMP TIMESTAMP_LTZ TIMESTAMP_NTZ TINYINT TO TRAILING TRIM TRUE
    UNBOUNDED UNKNOWN USING VARCHAR WHEN WHERE WITHIN
    """.split()
)

# Text literals and comments, and names in backticks, which may hold either's marks and are kept. A raw literal
# ends at its first quote, others escape by a backslash; both take their prefix along.
# Each star runs over a character class or is possessive, so long texts do not recurse
LITERALS = (
    r"(`[^`]*`)|\b[rR](?:'[^']*'|\"[^\"]*\")"
    r"|(?:\b[xX](?=['\"]))?(?:'[^'\\]*(?:\\.[^'\\]*)*+'|\"[^\"\\]*(?:\\.[^\"\\]*)*+\")"
    r"|--[^\n]*|/\*[^*]*\*+(?:[^/*][^*]*\*+)*+/"
)
UNITS = "YEAR|QUARTER|MONTH|WEEK|DAY|HOUR|MINUTE|SECOND|MILLISECOND|MICROSECOND|NANOSECOND"
# Words that are no names where they stand together, or behind another one:
# units of an interval, the unit that is the first argument of some date functions, time zones, collations, the
# fields of a struct type, and the path behind a colon
PHRASES = (
    rf"(?i)\bINTERVAL(?:[-+.0-9 ]+(?:{UNITS})S?\b)+(?: +TO +(?:{UNITS})S?\b)?"
    r"|\bEXTRACT *[(] *[A-Z_]+(?= +FROM\b)"
    rf"|\b(?:TIMESTAMPDIFF|TIMESTAMPADD|DATEDIFF|DATE_DIFF|DATEADD|DATE_ADD) *[(] *(?:(?:{UNITS})S?|DAYOFYEAR)(?= *,)"
    r"|\bAT +TIME +ZONE\b|\bWITH(?:OUT)?(?: +LOCAL)? +TIME +ZONE\b|\bCOLLATE +[\w.]+"
    r"|\bSTRUCT *<(?:[^()]|[(] *\d+ *(?:, *\d+ *)?[)])*>"
    r"|(?<!:):(?!:) *(?: `[^`]*`|\w+)(?:[.](?: ?`[^`]*`|\w+)|\[[^\]]*\])*"
)
# A word that a phrase cannot do without
PHRASE_WORDS = r"(?i)\b(?:INTERVAL|EXTRACT|TIMESTAMP(?:DIFF|ADD)|DATE_?(?:DIFF|ADD)|ZONE|COLLATE|STRUCT)\b|:"
# A name, also of several parts, with the dot before it if it is a field of a value, and the bracket behind it
# if it is a function
PART = r"(?:[A-Za-z0-9_#]++|`[^`]*+`)"
WORDS = rf"[.]?{PART}(?:[.](?: (?=`))?{PART})*+(?: *[(])?"
NO_NAME = r"^[.]|[(]$|^[0-9]+(?:[Ee][0-9]+)?(?:[LlSsYyDdFf]|[Bb][Dd])?(?:[.]|$)"
# The variables of a lambda: x -> or (x, y) ->
LAMBDAS = r"([A-Za-z0-9_#]+|[(][A-Za-z0-9_#, ]+[)]) *->"


def expression_references(expression: Column | str) -> Column:
    """Distinct upper-case column names of a SQL expression, as an array.

    Leaves out literals, comments, numbers, function names, intervals, units, types, collations, paths behind a
    colon, lambda variables and keywords. ``v.top`` is one name, since only the rules can tell a column of a view
    from a field of a column; a name in backticks is one too, whatever it holds. Works inside one row, so
    it neither explodes nor shuffles. Patterns are tried where one of their words or marks occurs only.
    """
    col = F.col(expression) if isinstance(expression, str) else expression
    marked = reduce(lambda a, b: a | b, [F.contains(col, F.lit(mark)) for mark in ("'", '"', "`", "--", "/*")])
    bare = F.when(marked, F.regexp_replace(col, LITERALS, " $1")).otherwise(col)
    bare = F.when(F.rlike(bare, F.lit(PHRASE_WORDS)), F.regexp_replace(bare, PHRASES, " , ")).otherwise(bare)
    # Upper case word by word, since words are ASCII but the text around them may not be; a long
    # text repeats its words, so only distinct ones are looked at.
    words = F.filter(F.array_distinct(_all(bare, WORDS, 0)), lambda word: ~F.rlike(word, F.lit(NO_NAME)))
    names = F.filter(F.transform(words, lambda word: F.upper(word)), lambda name: ~name.isin(*KEYWORDS))
    variables = F.split(F.translate(F.upper(F.concat_ws(",", _all(bare, LAMBDAS, 1))), "() ", ""), ",")
    free = F.filter(names, lambda name: ~F.array_contains(variables, F.substring_index(name, ".", 1)))
    names = F.when(F.contains(col, F.lit("->")), free).otherwise(names)
    return F.array_distinct(F.transform(names, lambda name: F.translate(F.replace(name, F.lit(". `"), F.lit(".")), "`", "")))


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def check_references(
    rules: DataFrame, source_columns: Sequence[str] | None = None
) -> DataFrame:
    """Uses of a column that no lower level of the same table defines, for rules above level 0.

    One row per rule and column: seq_no, TableName, ColumnName, Level, reference. Names are
    compared in upper case. Of ``a.b`` either the column ``a`` or, ``a`` being a view, ``b`` must be
    defined. Where a table has no level 0 the ``source_columns`` are visible too.

    Definitions shrink to the lowest level per name before they are joined, so a name defined and
    used very often costs one row on one side and is never paired with itself.
    """
    leveled = rules.withColumn("__level", level_number("Level")).withColumn("__table", F.lower("TableName"))
    uses = leveled.filter("__level > 0").select(
        "seq_no", "TableName", "ColumnName", "Level", "__level", "__table",
        F.explode(expression_references("Expression")).alias("reference"),
    )
    defined = leveled.groupBy(
        F.col("__table").alias("__in_table"), F.upper("ColumnName").alias("__name")
    ).agg(F.min("__level").alias("__first"))
    same = F.col("__table") == F.col("__in_table")
    parts = F.split("reference", "[.]")
    first, second = parts[0], F.when(F.size(parts) > 1, parts[1])
    missing = uses
    for name in (first, second):  # one after the other: an OR would pair all names of a table
        visible = same & (name == F.col("__name")) & (F.col("__first") < F.col("__level"))
        missing = missing.join(defined, visible, "left_anti")
    if source_columns is not None:
        names = [F.lit(name.upper()) for name in source_columns]
        with_level_0 = defined.filter("__first <= 0").select("__in_table").distinct()
        known = first.isin(*names) | F.coalesce(second.isin(*names), F.lit(False)) | F.col("reference").isin(*names)
        missing = missing.join(with_level_0, same, "left").filter(~(known & F.col("__in_table").isNull()))
    return missing.select("seq_no", "TableName", "ColumnName", "Level", "reference")
