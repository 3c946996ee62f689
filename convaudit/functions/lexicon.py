"""Lexicon (sensitive-word) predicates.

Two ways to test a sentence against a word list:

* inline: the list is small and bounded (checked by count before it is
  fetched), so it is compiled into the expression — a trie-shaped regular
  expression for substring containment, or a literal array for token equality.
  No join, no shuffle, runs in codegen.
* join: for lists above the bound, see ``operators.lexicon`` (token semi join,
  or an equi join on the text's substrings of the entries' lengths).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def minimal_entries(entries: Iterable[str]) -> list[str]:
    """Entries that contain no other entry; they alone decide containment."""
    every = set(entries)
    if "" in every:
        return [""]
    sizes = sorted({len(e) for e in every})

    def holds_another(e: str) -> bool:
        return any(e[i:i + n] in every for n in sizes if n < len(e) for i in range(len(e) - n + 1))

    return sorted((e for e in every if not holds_another(e)), key=lambda s: (len(s), s))


def _trie(words: Sequence[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}
    return root


def _trie_regex(node: dict) -> str:
    ends = "" in node
    branches = [re.escape(ch) + _trie_regex(child) for ch, child in sorted(node.items()) if ch != ""]
    if not branches:
        return ""
    body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
    if ends:
        # a shorter entry ends here; with minimal entries this never happens
        body = "(?:" + body + ")?"
    return body


def trie_pattern(entries: Iterable[str]) -> str | None:
    """One regular expression that finds any entry as a substring.

    Built from the minimal entries, factored on common prefixes so the regex
    engine walks a trie instead of trying every alternative at every position.
    ``None`` when the list is empty; ``""`` when it holds the empty entry
    (which every text contains).
    """
    words = minimal_entries(entries)
    if not words:
        return None
    if words[0] == "":
        return ""
    # one class test rules a position out before the branches are tried
    first = "".join(re.escape(c) for c in sorted({w[0] for w in words}))
    return f"(?=[{first}])" + _trie_regex(_trie(words))


def contains_any(text: Column, entries: Sequence[str]) -> Column:
    """True when ``text`` contains one of ``entries`` (exact substring)."""
    pat = trie_pattern(entries)
    if pat is None:
        return F.lit(False)
    if pat == "":
        return text.isNotNull()
    return F.coalesce(text.rlike(pat), F.lit(False))


def first_contained(text: Column, keywords: Column) -> Column:
    """First element of the array ``keywords`` (in array order) contained in ``text``."""
    return F.get(F.filter(keywords, lambda k: F.contains(text, k)), 0)


def sensitive(tokens: Column, entries: Sequence[str], mode: str = "substring") -> Column:
    """The sensitive-word predicate on a token array.

    ``substring``: an entry occurs in the tokens joined without separator
    (entries are phrases that span several segmenter tokens).
    ``token``: an entry equals a token.
    Tokens are lower case, so entries are folded to it.
    """
    entries = [e.lower() for e in entries if e is not None]
    if mode == "substring":
        return contains_any(F.concat_ws("", tokens), entries)
    if mode == "token":
        if not entries:
            return F.lit(False)
        lit = F.array(*[F.lit(e) for e in sorted(set(entries))])
        return F.coalesce(F.arrays_overlap(tokens, lit), F.lit(False))
    raise ValueError(f"unknown sensitive mode {mode!r}")
