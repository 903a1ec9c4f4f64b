"""Text column expressions: tokens, keyword containment, word tries."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a maximal run of letters, digits and apostrophes (Java / RE2 syntax).
TOKEN_SPLIT = r"[^\p{L}\p{N}']+"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Whole-text tokens in original case, empty pieces dropped (array<string>)."""
    return F.filter(F.split(F.coalesce(_c(text), F.lit("")), TOKEN_SPLIT), lambda t: t != F.lit(""))


def count_char(text, ch: str) -> Column:
    """Occurrences of one character in the whole text."""
    t = F.coalesce(_c(text), F.lit(""))
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


WORD_CHAR = re.compile(r"[^\W_]|'")

REGEX_META = set(".^$*+?()[]{}|\\")


def regex_quote(text: str) -> str:
    """Escape regex metacharacters (valid in Java and RE2 syntax)."""
    return "".join("\\" + ch if ch in REGEX_META else ch for ch in text)


def whole_word_pattern(keyword: str) -> str:
    """Keyword bounded by non-word characters or the text ends (no look-around, so the
    same pattern runs in Java and RE2)."""
    return r"(^|[^\p{L}\p{N}])" + regex_quote(keyword) + r"([^\p{L}\p{N}]|$)"


def keyword_match(lowered: Column, keyword: str, whole_word: bool = False) -> Column:
    """substring containment (Q4 default) or whole-word match."""
    if whole_word:
        # The literal search is cheap and rules out most texts; the boundary regex (a scan
        # from every position) runs only on texts that contain the keyword at all.
        return lowered.contains(F.lit(keyword)) & lowered.rlike(whole_word_pattern(keyword))
    return lowered.contains(F.lit(keyword))


def trie_pattern(words, tail: str = "", gap: str | None = None) -> str:
    """A pattern that matches the longest of ``words`` at a place.

    The words share their beginnings, so a place is settled in as many steps as characters match,
    however many words there are. ``tail`` must follow a word that ends in a letter, digit or
    apostrophe; ``gap`` stands for each blank of a word."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = tail if tail and WORD_CHAR.match(w[-1]) else ""

    def of(node: dict) -> str:
        parts = []
        for ch in sorted(k for k in node if k):
            run, child = ch, node[ch]
            while len(child) == 1 and "" not in child:  # no branch: one run of characters
                (ch, child), = child.items()
                run += ch
            quoted = regex_quote(run) if gap is None else gap.join(regex_quote(x) for x in run.split(" "))
            parts.append(quoted + of(child))
        body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""
        if "" not in node:
            return body
        end = node[""]
        return f"(?:{body}|{end})" if body else end

    return of(root)
