"""Flattened application payloads: one list of values in which whole numbers refer to other places of the list.

Negative references are constants; tagged lists stand for sets, maps, dates, big integers, boxed values, regular
expressions and objects without prototype; reactive wrappers fall away; an unknown tag keeps its name beside its value.
A reference to a value that is still being built becomes ``<cycle>``. Only the roots that are asked for are built.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Constants that negative references stand for, and tags that only wrap (fixed values).
CONSTANTS = {-1: None, -2: None, -3: "NaN", -4: "Infinity", -5: "-Infinity", -6: -0.0}
WRAPPERS = frozenset(("ShallowReactive", "Reactive", "ShallowRef", "Ref", "EmptyRef"))
CYCLE = "<cycle>"


def _even(cells: list) -> list:
    if len(cells) % 2:
        raise ValueError("a key without a value")
    return cells


def _named(keys: list) -> list:
    if not all(isinstance(k, str) for k in keys):
        raise ValueError("a key that is no text")
    return keys


def _pairs(values: list) -> list:
    return [list(p) for p in zip(values[::2], values[1::2], strict=True)]


def _first(values: list):
    return values[0] if values else None


#: How a tagged cell is read: the references among its arguments, and the value from what these stand for.
TAGS = {
    "Set": lambda args: (args, list),
    "Map": lambda args: (_even(args), _pairs),
    "null": lambda args: (_even(args)[1::2], lambda values, keys=_named(args[::2]): dict(zip(keys, values, strict=True))),
    "Date": lambda args: ([], lambda _: "" if _first(args) is None else args[0]),
    "BigInt": lambda args: ([], lambda _: int(_first(args))),
    "Object": lambda args: ([], lambda _: _first(args)),
    "RegExp": lambda args: ([], lambda _: dict(zip(("source", "flags"), [_first(args) or "", *args[1:2], ""], strict=False))),
} | dict.fromkeys(WRAPPERS, lambda args: (args[:1], _first))


def plan(cell):
    """References that a cell of the list holds, and the function that makes its value from what they stand for."""
    match cell:
        case dict():
            return list(cell.values()), lambda values: dict(zip(cell, values, strict=True))
        case [str() as tag, *args] if tag in TAGS:
            return TAGS[tag](args)
        case [str() as tag, arg]:
            return [arg], lambda values: {"__nuxt_type__": tag, "value": values[0]}
        case list():
            return cell, list
    return [], lambda _: cell


def values(flat: list, refs: list) -> list:
    """What references stand for; anything but a whole number stands for itself.

    Cells are entered when they are first referred to and made when all their references are known, with a stack of
    half-made cells in place of recursion, so payloads of any depth are read. A shared cell is made once.
    """
    made: dict[int, object] = {}
    # of each half-made cell: its number, what makes it, its references to come, their values so far; the first is the answer
    stack = [(None, list, iter(refs), [])]
    half_made: set[int | None] = set()
    while True:
        number, make, todo, known = stack[-1]
        for ref in todo:
            if type(ref) is not int:
                known.append(ref)
            elif ref in made:
                known.append(made[ref])
            elif ref in half_made:
                known.append(CYCLE)
            elif ref in CONSTANTS:
                known.append(CONSTANTS[ref])
            elif 0 <= ref < len(flat):
                inner, make_inner = plan(flat[ref])
                half_made.add(ref)
                stack.append((ref, make_inner, iter(inner), []))
                break
            else:
                raise ValueError(f"no value {ref}")
        else:
            stack.pop()
            value = make(known)
            if not stack:
                return value
            made[number] = value
            half_made.discard(number)
            stack[-1][3].append(value)


def read(text: str) -> tuple[list, dict]:
    """The list of a payload, and the references of its root object, which may stand behind wrappers."""
    flat = json.loads(text)
    if not isinstance(flat, list) or not flat:
        raise ValueError("a payload is a list with at least one value")
    at = 0
    for _ in flat:  # more steps than cells would be a circle
        match flat[at]:
            case dict() as refs:
                return flat, refs
            case [str() as tag, int() as inner, *_] if tag in WRAPPERS and 0 <= inner < len(flat):
                at = inner
            case _:
                break
    raise ValueError("the root is no object")


def decode(text: str, root: str | None = None):
    """One root of a payload, or the whole root object."""
    flat, refs = read(text)
    if root is not None:
        return values(flat, [refs.get(root)])[0]
    return dict(zip(refs, values(flat, list(refs.values())), strict=True))


def _plain(x):
    """A copy for JSON: no NUL, no infinite numbers."""
    if isinstance(x, str):
        return x.replace("\x00", " ")
    if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf"))):
        return str(x)
    if isinstance(x, dict):
        return {str(k).replace("\x00", " "): _plain(v) for k, v in x.items()}
    return [_plain(v) for v in x] if isinstance(x, list) else x


def devalue(payload: Column | str, root: str | None = None) -> Column:
    """Struct (value: JSON text with sorted keys, error) of a payload column; both null for a null payload."""

    @F.pandas_udf("value string, error string")
    def run(x: pd.Series) -> pd.DataFrame:
        rows = []
        for t in x:
            try:
                rows.append((None, None) if t is None else (json.dumps(_plain(decode(t, root)), ensure_ascii=False, sort_keys=True), None))
            except (ValueError, TypeError, RecursionError) as e:
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["value", "error"])

    return run(F.col(payload) if isinstance(payload, str) else payload)
