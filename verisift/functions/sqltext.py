"""Filter and condition texts read token by token.

The rule format writes identifiers in double quotes and text in single ones. Nothing
is rewritten by searching for quotes: a literal may hold any of them, a comment too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable, List, Optional, Sequence

_TOKEN = re.compile(
    r"""
    (?P<space>\s+|--[^\n]*|/\*.*?\*/)
  | (?P<string>'(?:[^'\\]|\\.|'')*')
  | (?P<quoted>"(?:[^"]|"")*")
  | (?P<ticked>`(?:[^`]|``)*`)
  | (?P<word>[^\W\d]\w*)
  | (?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)
  | (?P<op><=>|<=|>=|<>|!=|==|\|\||::|->|/\*|[^\s\w])
    """,
    re.X | re.S,
)


@dataclass(frozen=True)
class Token:
    kind: str
    text: str

    @property
    def name(self) -> Optional[str]:
        """The identifier that this token stands for, if it is one."""
        if self.kind == "word":
            return self.text
        if self.kind == "quoted":
            return self.text[1:-1].replace('""', '"')
        if self.kind == "ticked":
            return self.text[1:-1].replace("``", "`")
        return None

    def says(self, *words: str) -> bool:
        return self.kind in ("word", "op") and self.text.lower() in words


def tokens(text: str) -> List[Token]:
    """``text`` in tokens that put together again give ``text``."""
    out, at = [], 0
    for m in _TOKEN.finditer(text):
        if m.start() != at or (m.lastgroup == "op" and m[0] in ("'", '"', "`", "/*")):
            break
        out.append(Token(m.lastgroup, m[0]))
        at = m.end()
    if at != len(text):
        raise ValueError(f"a quote or comment is not closed in {text!r}")
    return out


def written(parts: Sequence[Token]) -> str:
    return "".join(t.text for t in parts)


def meaningful(parts: Sequence[Token]) -> List[Token]:
    return [t for t in parts if t.kind != "space"]


def back_quoted(parts: Sequence[Token]) -> List[Token]:
    """Double-quoted identifiers as Spark writes them; everything else as it is."""
    return [Token("ticked", "`" + t.name.replace("`", "``") + "`") if t.kind == "quoted" else t for t in parts]


def split_at(parts: Sequence[Token], word: str) -> List[List[Token]]:
    """The parts between ``word`` outside parentheses; the AND of a BETWEEN, and what is
    inside CASE ... END, stay whole."""
    out: List[List[Token]] = [[]]
    depth = cases = between = 0
    for t in parts:
        if t.says("("):
            depth += 1
        elif t.says(")"):
            depth -= 1
        elif t.says("case"):
            cases += 1
        elif t.says("end") and cases:
            cases -= 1
        elif depth == 0 and cases == 0:
            if t.says("between"):
                between += 1
            elif t.says("and") and between:
                between -= 1
            elif t.says(word):
                out.append([])
                continue
        out[-1].append(t)
    return out


def qualifiers(parts: Sequence[Token]) -> List[str]:
    """The names before a dot, in lower case and order, each once."""
    some = meaningful(parts)
    heads = [a.name.lower() for k, (a, b) in enumerate(zip(some, some[1:])) if a.name is not None and b.says(".") and not (k and some[k - 1].says("."))]
    return list(dict.fromkeys(heads))


def requalified(parts: Sequence[Token], to: Callable[[str], Optional[str]]) -> str:
    """The text with each ``alias.column`` under the alias that ``to`` gives, or bare for None."""
    some, out, k = back_quoted(meaningful(parts)), [], 0
    while k < len(some):
        t = some[k]
        if t.name is not None and k + 2 < len(some) and some[k + 1].says(".") and some[k + 2].name is not None:
            alias, column = to(t.name.lower()), "`" + some[k + 2].name.replace("`", "``") + "`"
            out.append(f"{alias}.{column}" if alias else column)
            k += 3
        else:
            out.append(t.text)
            k += 1
    return " ".join(out)
