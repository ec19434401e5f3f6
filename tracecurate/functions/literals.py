"""Python literals as JSON: dictionaries and lists that were stored by ``repr`` or ``str``.

A text is cut into tokens (quoted strings, brackets and separators, bare words), every token is
turned into its JSON spelling, and the whole is parsed. What is no literal gives text that is no
JSON, so it reads as null. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character belongs to a token; the quantifiers give nothing back, so that long strings
# cost no stack.
_TOKEN = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}(),:]|[^\s\[\]{}(),:'"]++|\s++|."""
_PIECE = r"(?s)\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\.|[^\\]++"
_NUMBER = r"^[+-]?(?:\d[\d_]*(?:\.[\d_]*)?|\.\d[\d_]*)(?:[eE][+-]?\d+)?$"
_WORDS = {"None": "null", "True": "true", "False": "false"}
_SAME_ESCAPES = ("\\\\", '\\"', "\\n", "\\r", "\\t", "\\b", "\\f")
_OTHER_ESCAPES = {"\\'": "'", "\\\n": "", "\\a": "\\u0007", "\\v": "\\u000b"}


def _unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.hex(code), 4, "0"))


def _piece_to_json(piece: Column) -> Column:
    """One escape, or the text between two, as it stands inside a JSON string."""
    number = F.conv(F.substring(piece, 3, 8), 16, 10).cast("bigint")
    beyond = number - 0x10000
    out = (
        F.when(~F.startswith(piece, F.lit("\\")), F.regexp_replace(F.regexp_replace(piece, '"', r'\\"'), "\t", r"\\t"))
        .when(F.startswith(piece, F.lit("\\u")) & (F.length(piece) == 6), piece)
        .when(F.startswith(piece, F.lit("\\x")) & (F.length(piece) == 4), F.concat(F.lit("\\u00"), F.substring(piece, 3, 2)))
        .when(
            F.startswith(piece, F.lit("\\U")) & (F.length(piece) == 10),
            F.when(number < 0x10000, _unit(number)).otherwise(
                F.concat(
                    _unit(F.shiftright(beyond, 10) + 0xD800),
                    _unit(beyond.bitwiseAND(1023) + 0xDC00),
                )
            ),
        )
        .when(F.rlike(piece, F.lit(r"^\\[0-7]")), _unit(F.conv(F.substring(piece, 2, 3), 8, 10).cast("bigint")))
        .when(piece.isin(*_SAME_ESCAPES), piece)
    )
    for escape, text in _OTHER_ESCAPES.items():
        out = out.when(piece == escape, F.lit(text))
    return out.otherwise(F.concat(F.lit("\\"), piece))  # an unknown escape stands for itself


def _string_to_json(token: Column) -> Column:
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    pieces = F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0)), _piece_to_json)
    return F.concat(F.lit('"'), F.array_join(pieces, ""), F.lit('"'))


def _number_to_json(token: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(token, "_", ""), r"^\+", "")
    return F.regexp_replace(F.regexp_replace(plain, r"^(-?)\.", "$10."), r"\.(?=[eE]|$)", ".0")


def _token_to_json(token: Column, after: Column) -> Column:
    """A token's JSON spelling; ``after`` is the next one. Keys that are no strings become some."""
    word = F.when(F.rlike(token, F.lit(_NUMBER)), _number_to_json(token))
    for name, text in _WORDS.items():
        word = word.when(token == name, F.lit(text))
    word = F.when(after == ":", F.concat(F.lit('"'), word, F.lit('"'))).otherwise(word)
    return (
        F.when(F.rlike(token, F.lit(r"""(?s)^['"].+""")), _string_to_json(token))
        .when((token == ",") & after.isin("]", "}", ")"), F.lit(""))  # a comma may come last
        .when(token == "(", F.lit("["))
        .when(token == ")", F.lit("]"))
        .when(token.isin("[", "]", "{", "}", ",", ":"), token)
        .otherwise(F.coalesce(word, F.lit("?")))  # any other name or sign is no literal
    )


def literal_to_json(text: Column) -> Column:
    """JSON text of a Python literal; of anything else, text that is no JSON.

    Tuples become lists and keys strings. Sets, bytes, and strings set side by side have no JSON.
    A value in round brackets reads as a tuple of one.
    """
    tokens = F.filter(
        F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda t: ~F.rlike(t, F.lit(r"^\s"))
    )

    def turned(found: Column) -> Column:
        return F.transform(found, lambda t, i: _token_to_json(t, F.coalesce(F.get(found, i + 1), F.lit(""))))

    # Bound once: the tokens are looked at twice for each of them.
    joined = F.transform(F.array(tokens), lambda found: F.array_join(turned(found), " "))
    return F.get(joined, F.lit(0))


def parse_literal(text: Column) -> Column:
    """A Python literal as VARIANT, null if it is none."""
    return F.try_parse_json(literal_to_json(text))
