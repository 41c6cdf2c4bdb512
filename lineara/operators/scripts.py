"""SQL scripts to statements, in Spark expressions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a script is read by. All repeats are possessive, which the engine runs as loops, so texts of any length are matched
#: in one pass without recursion.
COMMENT = r"(?:#|--(?=\s|\z))[^\n]*+|/\*(?:[^*]++|\*(?!/))*+(?:\*/|\z)"
QUOTED = "|".join([rf"{q}(?:[^{q}\\]++|\\.)*+(?:{q}|\\?+\z)" for q in "'\""] + [r"`[^`]*+(?:`|\z)"])
PIECE = rf"[^;'\"`#\\/-]++|\\.|{COMMENT}|{QUOTED}|[\\/-]"
#: Group 1 is a piece that has code: after white space and comments something stands before the semicolon.
STATEMENT = rf"(?s)\s*+(?:(?=(?:\s++|{COMMENT})*+[^;])((?:{PIECE})++)|(?:{PIECE})*+);?+"
BLANK = " \t\n\r\x0b\x0c"


def statements(df: DataFrame, ids: list[str], script: str) -> DataFrame:
    """ids, ordinal, statement: a script cut at the semicolons that stand outside quotes and comments, numbered from 0.

    Statements are trimmed and keep their comments; pieces without code (blank, or only comments) are left out, and a
    last one needs no semicolon. A quote or comment that is never closed runs to the end. A doubled quote closes and opens
    again, which comes to the same; after a backslash a quote or semicolon is text, but for backticks, which know no
    escapes; a block comment ends at the first */ after its opening. Null scripts give no rows. One pass of one pattern
    finds the statements, so the work is linear in the text. Commands that change the delimiter are not known.
    """
    found = F.array_remove(F.regexp_extract_all(F.col(script), F.lit(STATEMENT), F.lit(1)), "")
    return df.select(*ids, F.posexplode(found).alias("ordinal", "statement")).withColumn("statement", F.rtrim("statement", F.lit(BLANK)))
