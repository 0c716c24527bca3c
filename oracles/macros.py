"""Small text macros so that every query rounds and sums the same exact way."""

from __future__ import annotations

import re


def _rnd(x: str, n: str = "0") -> str:
    f = f"{10 ** int(n)}.0"
    rounded = f"CAST(sign({x}) AS BIGINT) * CAST(floor(abs({x}) * CAST({f} AS DOUBLE) + 0.5) AS BIGINT) / CAST({f} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) * CAST({f} AS DOUBLE) >= 9007199254740992 THEN CAST({x} AS DOUBLE) ELSE {rounded} END)"


def _exact(x: str, s: str = "8") -> str:
    return f"CAST({x} AS DECIMAL(28,{max(int(s), 8)}))"


MACROS = {
    # name: builder over the comma-separated arguments
    "RND": _rnd,
    "DBL": lambda x: f"CAST({x} AS DOUBLE)",
    "DEC": lambda x, s="2": f"CAST({x} AS DECIMAL(18,{s}))",
    "RATIO": lambda a, b: f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))",
    "PCT": lambda a, b: f"(CAST({a} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({b} AS DOUBLE), 0))",
    "TOT": lambda x, s="8": f"CAST(SUM({_exact(x, s)}) AS DOUBLE)",
    "TOTI": lambda x: f"CAST(SUM({x}) AS BIGINT)",
    "MEAN": lambda x, s="8": f"(CAST(SUM({_exact(x, s)}) AS DOUBLE) / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))",
    "CNT": lambda c: f"COUNT(*) FILTER (WHERE {c})",
}
MACROS["AVGR"] = lambda x, n, s="8": _rnd(MACROS["MEAN"](x, s), n)
MACROS["SHARE"] = lambda c: _rnd(MACROS["PCT"](MACROS["CNT"](c), "COUNT(*)"), "1")

_CALL = re.compile(r"\b(" + "|".join(sorted(MACROS, key=len, reverse=True)) + r")\(")


def _arguments(text: str, start: int) -> tuple[list[str], int]:
    """Arguments of the call whose opening bracket is at ``start``; brackets and quotes nest."""
    depth, parts, begin, quoted = 0, [], start + 1, False
    for i in range(start, len(text)):
        c = text[i]
        if c == "'":
            quoted = not quoted
        if quoted:
            continue
        if c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
            if depth == 0:
                parts.append(text[begin:i].strip())
                return parts, i
        elif c == "," and depth == 1:
            parts.append(text[begin:i].strip())
            begin = i + 1
    raise ValueError(f"unbalanced macro call in: {text}")


def expand(sql: str) -> str:
    found = _CALL.search(sql)
    if not found:
        return sql
    args, end = _arguments(sql, found.end() - 1)
    body = MACROS[found.group(1)](*[expand(a) for a in args])
    return sql[: found.start()] + body + expand(sql[end + 1 :])
