"""Conditions as a form writes them (``${q} = '1' and selected(${r}, 'a')``) turned into Spark SQL.

Only the form's own words are replaced; precedence, brackets and types of the rest are Spark's.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

TOKEN = re.compile(
    r"\s*(?:(?P<var>\$\{\s*[^}\s]+\s*\})|(?P<text>'[^']*'|\"[^\"]*\")|(?P<number>\d+(?:\.\d+)?)"
    r"|(?P<name>[A-Za-z_][\w:-]*)|(?P<op><=|>=|!=|[=<>+*(),-]))"
)
COMPARISONS = {"=", "!=", "<", "<=", ">", ">="}
WORDS = {"and": "AND", "or": "OR", "not": "NOT", "div": "/", "mod": "%"}
# Functions of a form with the same arguments in Spark.
FUNCTIONS = {
    "if": "if",
    "coalesce": "coalesce",
    "contains": "contains",
    "starts-with": "startswith",
    "ends-with": "endswith",
    "string-length": "length",
    "regex": "rlike",
    "round": "round",
    "floor": "floor",
    "ceiling": "ceil",
    "true": "true",
    "false": "false",
}
# Functions of one answer.
OF_ANSWER = {
    "count-selected": "size(filter(split({0}, ' +'), x -> x <> ''))",
    "number": "try_cast({0} as double)",
    "int": "try_cast(try_cast({0} as double) as bigint)",
    "string": "{0}",
}


def _column(token: str) -> str:
    return "`" + token[2:-1].strip().replace("`", "``") + "`"


def _text(token: str) -> str:
    """An operand as text: an answer that is missing is the empty text."""
    if token.startswith("${"):
        return f"coalesce(cast({_column(token)} as string), '')"
    return "'" + token[1:-1].replace("\\", "\\\\").replace("'", "\\'") + "'" if token[0] in "'\"" else token


def _is_number(token: str) -> bool:
    return bool(re.fullmatch(r"-?\d+(\.\d+)?", token.strip("'\" ")))


def _number(token: str) -> str:
    if token.startswith("${"):
        return f"try_cast(cast({_column(token)} as string) as double)"
    return f"{token.strip(chr(39) + chr(34) + ' ')}D" if _is_number(token) else f"try_cast({_text(token)} as double)"


def _compared(left: str, op: str, right: str) -> str:
    """Two operands: as numbers where an order is asked for or one of them is a number, else as texts."""
    numeric = op not in ("=", "!=") or _is_number(left) or _is_number(right)
    side = _number if numeric else _text
    unknown = "true" if op == "!=" else "false"
    return f"coalesce({side(left)} {op} {side(right)}, {unknown})"


def relevance_sql(text: str | None) -> str | None:
    """A form's condition as a Spark SQL predicate that is never NULL; NULL for no condition.

    A missing answer is the empty text: it equals nothing else and is in no order. ``'2'`` and ``2`` are the same
    number, so ``01`` and ``1`` are equal; other quoted values are compared as texts. ``selected(${q}, 'a')`` looks
    for a whole word. A word that a form does not have, or brackets that don't match, is an error.
    """
    if text is None or not text.strip():
        return None
    tokens: list[tuple[str, str]] = []
    at = 0
    while text[at:].strip():
        found = TOKEN.match(text, at)
        if found is None:
            raise ValueError(f"not a form condition from {text[at:].strip()!r} on: {text!r}")
        tokens.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()

    def operand(k: int) -> bool:
        return 0 <= k < len(tokens) and tokens[k][0] in ("var", "text", "number")

    def symbols(k: int, *wanted: str | None) -> bool:
        """Whether these symbols follow; None stands for one operand."""
        return all(operand(k + i) if w is None else k + i < len(tokens) and tokens[k + i][1] == w for i, w in enumerate(wanted))

    out: list[str] = []
    k = depth = 0
    while k < len(tokens):
        kind, token = tokens[k]
        if token == "selected" and symbols(k + 1, "(", None, ",", None, ")"):
            out.append(f"array_contains(split({_text(tokens[k + 2][1])}, ' +'), {_text(tokens[k + 4][1])})")
            k += 6
        elif token in OF_ANSWER and symbols(k + 1, "(", None, ")"):
            out.append(OF_ANSWER[token].format(_text(tokens[k + 2][1])))
            k += 4
        elif operand(k) and k + 1 < len(tokens) and tokens[k + 1][1] in COMPARISONS and operand(k + 2) and not _in_sum(tokens, k):
            out.append(_compared(token, tokens[k + 1][1], tokens[k + 2][1]))
            k += 3
        elif operand(k):
            near = [tokens[i][1] for i in (k - 1, k + 1) if 0 <= i < len(tokens)]
            sums = any(x in COMPARISONS or x in "+-*" or x in ("div", "mod") for x in near)
            out.append(_number(token) if sums and (kind == "var" or _is_number(token)) else _text(token))
            k += 1
        elif kind == "op":
            depth += (token == "(") - (token == ")")
            if depth < 0:
                break
            out.append(token)
            k += 1
        elif token.lower() in WORDS:
            out.append(WORDS[token.lower()])
            k += 1
        elif token in FUNCTIONS and symbols(k + 1, "("):
            closed = token in ("true", "false") and symbols(k + 1, "(", ")")
            out.append(FUNCTIONS[token])
            k += 3 if closed else 1
        else:
            raise ValueError(f"{token!r} is not known in form conditions: {text!r}")
    if depth:
        raise ValueError(f"brackets don't match: {text!r}")
    return f"coalesce({' '.join(out)}, false)"


def _in_sum(tokens: Sequence[tuple[str, str]], k: int) -> bool:
    """Whether the comparison that begins at ``k`` has a sum on one of its sides."""
    around = [tokens[i][1] for i in (k - 1, k + 3) if 0 <= i < len(tokens)]
    return any(x in ("+", "-", "*", "div", "mod") for x in around)
