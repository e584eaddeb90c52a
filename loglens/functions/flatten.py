"""The members of one JSON text as flat keys and texts. A helper inside tasks."""

from __future__ import annotations

import json
import operator
import re
from json.decoder import scanstring

MALFORMED = "malformed JSON"
MISSING = "missing text"
NOT_OBJECTS = "neither an object nor an array of objects"


class _Object(list):
    """Members of a JSON object as (name, value) pairs, repeated names included."""


def _refuse(constant):
    raise ValueError(constant)


_NAME = operator.itemgetter(0)


def make_decoder() -> json.JSONDecoder:
    """Numbers keep the text they were written with."""
    return json.JSONDecoder(
        object_pairs_hook=_Object, parse_float=str, parse_int=str, parse_constant=_refuse
    )


def flat_objects(text, decoder):
    """``([({key: text}, collisions), ..], None)``, or ``(None, reason)``.

    One pair for each object of the text. Texts that are long, or nested more deeply than
    the library's parser goes, are flattened while they are read, with a stack of their own.
    """
    if text is None:
        return None, MISSING
    if len(text) <= WHOLE_TEXT:
        try:
            objects, reason = parse_objects(text, decoder)
            return objects and [flatten_object(o) for o in objects], reason
        except RecursionError:
            pass
    try:
        return read_objects(text)
    except ValueError:
        return None, MALFORMED


def parse_objects(text, decoder):
    """``(objects, None)``, or ``(None, reason)`` when the text does not qualify."""
    try:
        value = decoder.decode(text)
    except ValueError:
        return None, MALFORMED
    if isinstance(value, _Object):
        return [value], None
    if isinstance(value, list) and all(isinstance(v, _Object) for v in value):
        return value, None
    return None, NOT_OBJECTS


def flatten_object(members):
    """``({key: text}, collisions)``; of equal keys the greatest path stays.

    Members are visited in the order of their paths, so a later one replaces an
    earlier one. An own stack allows any depth the parser allows.
    """
    found, leaves = {}, 0
    stack = [(iter(sorted(members, key=_NAME)), True, "")]
    while stack:
        items, in_object, prefix = stack[-1]
        for name, member in items:
            kind = type(member)
            if kind is str:
                if in_object and member == "null":
                    continue
            elif kind is bool:
                member = "true" if member else "false"
            elif kind is _Object:
                inherited = prefix if in_object else f"{prefix}{name + 1}"
                stack.append((iter(sorted(member, key=_NAME)), True, inherited))
                break
            elif kind is list:
                stack.append((iter(enumerate(member)), False, name if in_object else f"{prefix}{name}"))
                break
            else:
                continue
            found[prefix + name if in_object else f"{prefix}{name + 1}"] = member
            leaves += 1
        else:
            stack.pop()
    return found, leaves - len(found)


# Longer texts are never held as a tree of Python objects.
WHOLE_TEXT = 8 * 1024 * 1024
_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")
_WORDS = (("true", "true"), ("false", "false"), ("null", None))
# Kinds of an open container, and of a value of the outermost list that is no object.
_OBJECT, _LIST, _OTHER = range(3)


class _Place:
    """A member's place: its container's, its name or position, its number there."""

    __slots__ = ("above", "depth", "name", "number")

    def __init__(self, above, name, number):
        self.above, self.name, self.number = above, name, number
        self.depth = above.depth + 1 if above else 0

    def after(self, other):
        """Whether this path is greater, compared name by name and position by position."""
        a, b = self, other
        while a.depth > b.depth:
            a = a.above
        while b.depth > a.depth:
            b = b.above
        while a.above is not b.above:
            a, b = a.above, b.above
        return (a.name, a.number) > (b.name, b.number)


class _Flat:
    """The members of one object found so far; the greatest path of a key stays."""

    def __init__(self):
        self.found, self.places, self.leaves = {}, {}, 0

    def add(self, key, text, place):
        self.leaves += 1
        if key not in self.found or place.after(self.places[key]):
            self.found[key], self.places[key] = text, place

    def result(self):
        return self.found, self.leaves - len(self.found)


def _scalar(text, at):
    """``(value as text or None, end)`` of the scalar at ``at``; ValueError if there is none."""
    if text[at : at + 1] == '"':
        return scanstring(text, at + 1, True)
    number = _NUMBER.match(text, at)
    if number:
        return number.group(), number.end()
    for word, value in _WORDS:
        if text.startswith(word, at):
            return value, at + len(word)
    raise ValueError(at)


def read_objects(text):
    """:func:`flat_objects` of any depth: the text is read once, without a tree.

    Open containers are a list of ``[kind, flat, prefix, place, members so far, end sign, part]``,
    where ``flat`` collects the object of the result they belong to. A prefix is put together
    (from the part that each container adds) only where a scalar needs it, so that deep nests
    of lists do not hold one long prefix a level.
    """
    space = _SPACE.match
    results, plain, stack = [], True, []
    at = space(text, 0).end()
    name, part = None, ""
    while True:
        # A value begins at ``at``; ``name`` is set within an object.
        opening = text[at : at + 1]
        top = stack[-1] if stack else None
        if opening in ("{", "["):
            kind = _OBJECT if opening == "{" else _LIST
            if top is None:
                flat = _Flat() if kind == _OBJECT else None
                entry = [kind, flat, "", _Place(None, "", 0), 0]
            elif top[1] is None:
                # In the outermost list: an object begins a result of its own.
                if kind == _LIST or top[0] == _OTHER:
                    plain, entry = False, [_OTHER, None, "", None, 0]
                else:
                    entry = [kind, _Flat(), "", _Place(None, "", 0), 0]
            else:
                number = top[4]
                part = ""
                if top[0] == _OBJECT:
                    place = _Place(top[3], name, number)
                    prefix = top[2] if kind == _OBJECT else name
                else:
                    place, prefix = _Place(top[3], number, 0), None
                    part = str(number + 1 if kind == _OBJECT else number)
                entry = [kind, top[1], prefix, place, 0]
            entry += ["}" if opening == "{" else "]", part]
            stack.append(entry)
            at = space(text, at + 1).end()
            if text[at : at + 1] != entry[5]:
                name, at = _name(text, at) if opening == "{" else (None, at)
                continue
            closed = True
        else:
            quoted = opening == '"'
            value, at = _scalar(text, at)
            if top is None or top[1] is None:
                plain = plain and top is not None and top[0] == _OTHER
            elif value is not None and not (top[0] == _OBJECT and quoted and value == "null"):
                if top[2] is None:
                    top[2] = _prefix(stack)
                if top[0] == _LIST:
                    top[1].add(f"{top[2]}{top[4] + 1}", value, _Place(top[3], top[4], 0))
                else:
                    top[1].add(top[2] + name, value, _Place(top[3], name, top[4]))
            closed = False
        # Behind a value, or at the end of an empty container: close what ends here.
        while True:
            at = space(text, at).end()
            if not stack:
                if at < len(text):
                    raise ValueError(at)
                return (results, None) if plain else (None, NOT_OBJECTS)
            entry = stack[-1]
            if not closed:
                entry[4] += 1
            sign = text[at : at + 1]
            if sign == entry[5]:
                stack.pop()
                at += 1
                outer = stack[-1] if stack else None
                if entry[0] == _OBJECT and (outer is None or outer[1] is None):
                    results.append(entry[1].result())
                closed = False
                continue
            if sign != "," or closed:
                raise ValueError(at)
            at = space(text, at + 1).end()
            name, at = _name(text, at) if entry[5] == "}" else (None, at)
            break


def _prefix(stack):
    """The prefix of the innermost container."""
    parts, i = [], len(stack) - 1
    while stack[i][2] is None:
        parts.append(stack[i][6])
        i -= 1
    return stack[i][2] + "".join(reversed(parts))


def _name(text, at):
    """``(name, start of its value)`` of the member at ``at``."""
    if text[at : at + 1] != '"':
        raise ValueError(at)
    name, at = scanstring(text, at + 1, True)
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(at)
    return name, _SPACE.match(text, at + 1).end()


def whole_characters(text: str) -> str:
    """Replace halves of surrogate pairs, which a text column cannot hold."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
