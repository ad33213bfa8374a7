"""Log line formats: bracketed, task, and pipe-separated service lines; anything else is raw."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardspark.functions.clean import timestamp

# The line formats, tried in this order.
BRACKET_LINE = r"\[([^\]]+)\]\s+(\w+)\s+\[([^\]]+)\]\s+—\s+(.*)"
TASK_LINE = r"\[([\d\-:,.\s+T]+)\]\s+\{([^}]+)\}\s+-\s+(.*)"
SERVICE_LINE = r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\S*)\s+\|\s+(\w+)\s+\|\s+([^|]+?)\s+\|\s+(.*)"

_ANY_LINE = rf"(?s)^(?:{BRACKET_LINE}|{TASK_LINE}|{SERVICE_LINE})\z"
# One match rewrites a line to its groups, one per output line; a line has no line break of
# its own. The three message groups, of which two are empty, come last.
_GROUPS = "\n".join(["", "$1", "$2", "$3", "$5", "$6", "$8", "$9", "$10", "$4$7$11"])


def line_fields(line: Column) -> Column:
    """Array of the fields found in a line; one element when no format matches.

    Put it in a column of its own before ``parse_fields``, so that it is evaluated once.
    """
    return F.split(F.regexp_replace(line, _ANY_LINE, _GROUPS), "\n", 10)


def parse_fields(fields: Column, line: Column) -> Column:
    """Struct (format, event_time, level, logger, message) from the fields of a line.

    Lines without a readable time keep a null ``event_time``.
    """

    def at(position: int) -> Column:
        return F.get(fields, F.lit(position))

    def stamp(text: Column) -> Column:
        # A comma before the fraction is how the logging libraries of Python write it.
        return timestamp(F.regexp_replace(text, r"(?<=:\d\d),", "."))

    def document(name: str, time: Column, level: Column, logger: Column, message: Column) -> Column:
        return F.struct(
            F.lit(name).alias("format"), time.alias("event_time"), level.alias("level"),
            logger.alias("logger"), message.alias("message"),
        )

    no_time = F.lit(None).cast("timestamp_ntz")
    return (
        F.when(
            F.size(fields) < 10, document("raw", no_time, F.lit("INFO"), F.lit("raw"), line)
        )
        .when(at(1) != "", document("bracket", stamp(at(1)), at(2), at(3), at(9)))
        .when(at(4) != "", document("task", stamp(at(4)), F.lit("INFO"), at(5), at(9)))
        .otherwise(document("service", stamp(at(6)), at(7), at(8), at(9)))
    )


def is_blank(line: Column) -> Column:
    return F.trim(line) == ""
