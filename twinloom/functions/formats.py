"""Python ``strftime`` formats as Spark date patterns."""

from __future__ import annotations

from twinloom.errors import SpecError

# Strftime directive -> Spark datetime pattern.
DIRECTIVES = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "I": "hh",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "j": "DDD",
    "b": "MMM",
    "B": "MMMM",
    "a": "E",
    "A": "EEEE",
    "p": "a",
}

_DIGIT_DIRECTIVES = frozenset("YymdHIMSfj")
_DAY_SETS = ({"Y", "m", "d"}, {"Y", "b", "d"}, {"Y", "B", "d"}, {"Y", "j"})
_SECOND_SETS = ({"H", "M", "S"}, {"I", "p", "M", "S"})


def _tokens(strftime_format: str):
    """Yield ``(directive, None)`` or ``(None, literal text)``."""
    literal, chars = "", iter(strftime_format)
    for char in chars:
        if char != "%":
            literal += char
            continue
        directive = next(chars, "")
        if directive == "%":
            literal += "%"
            continue
        if directive not in DIRECTIVES:
            raise SpecError(f"Unsupported directive %{directive} in format {strftime_format!r}")
        if literal:
            yield None, literal
            literal = ""
        yield directive, None
    if literal:
        yield None, literal


def spark_pattern(strftime_format: str) -> str:
    """Translate the format; literal text is quoted so no letter is read as a pattern."""
    return "".join(
        DIRECTIVES[directive] if directive else "'" + text.replace("'", "''") + "'"
        for directive, text in _tokens(strftime_format)
    )


def renders_only_digits(strftime_format: str) -> bool:
    return all(
        directive in _DIGIT_DIRECTIVES if directive else text.isdigit()
        for directive, text in _tokens(strftime_format)
    )


def keeps_every_day(strftime_format: str) -> bool:
    """True when two different days can never give the same text."""
    return _fixed_width(strftime_format) and any(
        needed <= _directives(strftime_format) for needed in _DAY_SETS
    )


def keeps_every_second(strftime_format: str) -> bool:
    return keeps_every_day(strftime_format) and any(
        needed <= _directives(strftime_format) for needed in _SECOND_SETS
    )


def _directives(strftime_format: str) -> set[str]:
    return {directive for directive, _ in _tokens(strftime_format) if directive}


def _fixed_width(strftime_format: str) -> bool:
    return not {"B", "A"} & _directives(strftime_format)
