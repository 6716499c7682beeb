"""Web server access logs in the combined format with one more quoted field."""

from __future__ import annotations

from pyspark.sql import functions as F

# Fixed value: the time format inside a line.
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


# Quoted text, in which a backslash takes the next character as it is.
_QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_LINE = rf"^([0-9A-Fa-f:.]+) \S+ \S+ \[([^\]]+)\] {_QUOTED} (\d{{3}}) (\d+|-) {_QUOTED} {_QUOTED}(?: {_QUOTED})?\s*$"
_CUT = "\u0001"
_ESCAPE = "\u0002"


def parse_lines(df, column="value"):
    """One row per line; all fields of a line in another format are null.

    One anchored pattern takes a line apart, escaped quotes included, which stay
    escaped. A line counts only if it has an address, a time that exists and a status.
    Fields are cut at U+0001; in a line that holds that character itself it is written
    as U+0002 and a letter meanwhile, which the pattern treats alike.
    """
    line, own, escape = F.col(column), F.lit(_CUT), F.lit(_ESCAPE)
    odd = F.contains(line, own)
    spelt = F.replace(F.replace(line, escape, F.lit(f"{_ESCAPE}b")), own, F.lit(f"{_ESCAPE}a"))
    groups = _CUT.join(f"${i}" for i in range(1, 8))
    parts = F.split(F.regexp_replace(F.when(odd, spelt).otherwise(line), _LINE, groups), _CUT)
    # A line that the pattern does not match comes back in one part.
    cut = df.select(odd.alias("odd"), F.when(F.size(parts) == 7, parts).alias("parts"))

    def part(i):
        return F.get("parts", F.lit(i))

    def text(c):
        plain = F.replace(F.replace(c, F.lit(f"{_ESCAPE}a"), own), F.lit(f"{_ESCAPE}b"), escape)
        return F.when(F.col("odd"), plain).otherwise(c)

    timed = cut.select("odd", "parts", F.try_to_timestamp(part(1), F.lit(TIME_FORMAT)).alias("ts"))
    whole = timed.select("odd", F.when(F.col("ts").isNotNull(), F.col("parts")).alias("parts"), "ts")
    request = part(2)
    target = F.substring(request, F.instr(request, " ") + 1, F.length(request))
    return whole.select(
        part(0).alias("ip"),
        "ts",
        text(F.substring_index(request, " ", 1)).alias("request_type"),
        text(F.regexp_replace(target, r" HTTP/\S+$", "")).alias("path"),
        part(3).try_cast("int").alias("status"),
        part(4).try_cast("long").alias("response_size"),
        text(part(5)).alias("referer"),
        text(part(6)).alias("agent"),
    )


def read_access_log(spark, path):
    """Parsed lines of log files."""
    return parse_lines(spark.read.text(path))


def stream_access_log(spark, path):
    """Parsed lines as files arrive."""
    return parse_lines(spark.readStream.text(path))
