"""Function calls inside rule text: find them, and write the library's names as built-ins."""

from __future__ import annotations

import re
from collections.abc import Callable

WORD = re.compile(r"\w+")
NAME = re.compile(r"[A-Za-z_]\w*")
BLANK = re.compile(r"\s*")
OVER = re.compile(r"\s*\bOVER\s*(?=\()", re.I)
SUBQUERY = re.compile(r"\s*(?:SELECT|WITH|FROM|VALUES|TABLE|MAP|REDUCE)\b(?!\s*\()", re.I)
RAW_PREFIX = re.compile(r"(?:^|\W)[rR]\Z")
COMMENT_EDGE = re.compile(r"/\*|\*/")

Replace = Callable[[str, str, "str | None"], "str | None"]


def skip_quoted(text: str, at: int) -> int:
    """The end of the literal, quoted name or comment that starts at ``at``; else ``at``."""
    char = text[at]
    if char in "'\"" and RAW_PREFIX.search(text, max(at - 2, 0), at):
        end = text.find(char, at + 1)  # a raw literal knows no escapes
        return len(text) if end < 0 else end + 1
    if char in "'\"":
        end = at + 1
        while end < len(text) and text[end] != char:
            end += 2 if text[end] == "\\" else 1
        return min(end + 1, len(text))
    if char == "`":
        end = text.find("`", at + 1)
        return len(text) if end < 0 else end + 1
    if text.startswith("--", at):
        end = text.find("\n", at)
        return len(text) if end < 0 else end + 1
    if text.startswith("/*", at):
        depth = 0
        for edge in COMMENT_EDGE.finditer(text, at):
            depth += 1 if edge[0] == "/*" else -1
            if not depth:
                return edge.end()
        return len(text)
    return at


def closing_bracket(text: str, opening: int) -> int | None:
    """The bracket that closes the one at ``opening``, at any depth; None if there is none."""
    depth, at = 0, opening
    while at < len(text):
        end = skip_quoted(text, at)
        if end > at:
            at = end
            continue
        depth += {"(": 1, ")": -1}.get(text[at], 0)
        if not depth:
            return at
        at += 1
    return None


def _brackets(text: str) -> dict[int, int]:
    """Where each bracket closes, in one pass; brackets that are never closed are left out."""
    closing, open_ = {}, []
    at = 0
    while at < len(text):
        end = skip_quoted(text, at)
        if end == at:
            if text[at] == "(":
                open_.append(at)
            elif text[at] == ")" and open_:
                closing[open_.pop()] = at
            end = at + 1
        at = end
    return closing


def _is_subquery(text: str, at: int, end: int) -> bool:
    while at < end:
        at = BLANK.match(text, at).end()
        after = skip_quoted(text, at) if text[at : at + 2] in ("--", "/*") else at
        if after == at:
            return SUBQUERY.match(text, at, end) is not None
        at = after
    return False


def replace_calls(text: str, replace: Replace, subqueries: bool = False) -> str:
    """Replace function calls, outermost first, leaving literals, quoted names and comments alone.

    ``replace(name, args, over)`` gets the lower-case name, the argument text and the window text
    (None without OVER). It returns the new text, or None to keep the call and look inside it.
    What stands inside a subquery belongs to other rows and is looked at with ``subqueries`` only.
    """
    out, at = [], 0
    closings = _brackets(text)
    windows: dict[int, int] = {}  # the window behind the bracket that closes a kept call is kept as it is
    while at < len(text):
        end = skip_quoted(text, at)
        if end > at:
            out.append(text[at:end])
            at = end
            continue
        word = WORD.match(text, at)
        if word is None and text[at] != "(":
            end = windows.get(at, at + 1)
            out.append(text[at:end])
            at = end
            continue
        opening = BLANK.match(text, word.end()).end() if word else at
        closing = closings.get(opening)
        if closing is None:
            end = word.end() if word else at + 1
            out.append(text[at:end])
            at = end
            continue
        end = closing + 1
        called = word is not None and NAME.fullmatch(word[0]) and (at == 0 or text[at - 1] not in ".`")
        if called:
            window = OVER.match(text, end)
            last = closings.get(window.end()) if window else None
            over = None
            if last is not None:
                over, end = text[window.end() + 1 : last], last + 1
            new = replace(word[0].lower(), text[opening + 1 : closing], over)
            if new is not None:
                out.append(new)
                at = end
                continue
            windows[closing] = end
        if not subqueries and _is_subquery(text, opening + 1, closing):
            out.append(text[at:end])
            at = end
            continue
        out.append(text[at : opening + 1])  # and on with what is inside
        at = opening + 1
    return "".join(out)


def split_arguments(args: str) -> list[str]:
    """The arguments of a call, split at its outermost commas."""
    parts, first, depth, at = [], 0, 0, 0
    while at < len(args):
        end = skip_quoted(args, at)
        if end > at:
            at = end
            continue
        depth += {"(": 1, ")": -1}.get(args[at], 0)
        if args[at] == "," and not depth:
            parts.append(args[first:at])
            first = at + 1
        at += 1
    return [part.strip() for part in [*parts, args[first:]] if part]


def calls_any(text: str, names: frozenset[str], windowed: bool = False) -> bool:
    """Whether ``text`` calls one of ``names``; calls with OVER count only if ``windowed``."""
    found = False

    def look(name: str, args: str, over: str | None) -> None:
        nonlocal found
        found = found or (name in names and (windowed or over is None))

    replace_calls(text, look)
    return found


def expand_calls(text: str) -> str:
    """Write MostCommon, WeightedAverage and CollectWs calls as built-in SQL."""

    def one(name: str, args: str, over: str | None) -> str | None:
        window = "" if over is None else f" OVER ({over})"
        if name == "mostcommon":
            return f"mode(CAST({expand_calls(args)} AS STRING), true){window}"
        if name == "collectws":
            return f"array_join(CAST({expand_calls(args)} AS ARRAY<STRING>), ','){window}"
        if name == "weightedaverage":
            weight, value = split_arguments(expand_calls(args))
            w = f"coalesce(try_cast({weight} AS DOUBLE), 0D)"
            v = f"coalesce(try_cast({value} AS DOUBLE), 0D)"
            total, weights = f"sum({w} * {v}){window}", f"sum({w}){window}"
            ratio = (
                f"CASE WHEN {weights} <> 0 THEN {total} / {weights} "
                f"WHEN isnan({total}) THEN NULL "
                f"WHEN {total} > 0 THEN double('Infinity') "
                f"WHEN {total} < 0 THEN double('-Infinity') END"
            )
            return f"nullif({ratio}, double('NaN'))"
        return None

    return replace_calls(text, one, subqueries=True)
