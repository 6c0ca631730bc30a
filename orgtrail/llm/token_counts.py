"""Token counts that follow edits: segment trees over the pre-tokens of a document.

A text is split into pre-tokens by the tokenizer's pattern, and each is counted. Runs of
pre-tokens are the leaves of a tree whose nodes hold the sums of characters and tokens below.
An edit finds its leaves by descending the character sums; those leaves are split and counted
again, beginning one leaf early if the edit touches a leaf's first character, and going on
leaf by leaf until a pre-token of the new text ends where a leaf of the old text did: from
there on the split of the old text holds, since the pattern only looks ahead. The sums of the
touched leaves' ancestors are then updated.

The rank file of a public byte-level BPE is read on the driver and broadcast; its path is a
parameter. Counts of recent pre-tokens are remembered in each worker, up to a bound.

Edge cases: a null text is empty and has 0 tokens; edits that begin or end beyond the text are
cut to it, a null list of edits is empty; edits are applied one after the other, each to what
the ones before left; texts of any length are counted whole; repeated rows are counted each; an
empty table gives no rows; clashing columns are replaced.
"""

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that belongs to the rank file: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens of a leaf when it is made, and how often that it may grow to before all are remade.
LEAF, GROWN = 32, 8
#: Pre-tokens a worker remembers.
REMEMBERED = 200_000

COUNTS = "n_chars long, n_tokens long, edited_chars long, edited_tokens long, reencoded_chars long"
EDITS = "array<struct<at:int,cut:int,put:string>>"


class Counter:
    """Tokens of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.split = regex.compile(PATTERN)
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.seen: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.seen.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[piece] = n
        return n


class CountTree:
    """One document's text in leaves, with sums of characters and tokens above them."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.reencoded = 0
        self._build(text)

    def _build(self, text: str) -> None:
        pieces = self.counter.split.findall(text)
        count = self.counter.count
        groups = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.leaves = ["".join(g) for g in groups]
        self.width = 1 << (len(groups) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        for i, g in enumerate(groups):
            self.chars[self.width + i] = len(self.leaves[i])
            self.tokens[self.width + i] = sum(map(count, g))
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where in it; the last one for the text's end."""
        node = 1
        while node < self.width:
            left = self.chars[2 * node]
            if at < left or not self.chars[2 * node + 1]:
                node = 2 * node
            else:
                at -= left
                node = 2 * node + 1
        return node - self.width, at

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = self.width + leaf
        self.chars[node], self.tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, at: int, cut: int, put: str) -> None:
        """Replace ``cut`` characters from ``at`` by ``put``."""
        at = min(max(at, 0), self.n_chars)
        cut = min(max(cut, 0), self.n_chars - at)
        if not cut and not put:
            return
        # The pre-token before looked at the first character that changes, and may have
        # looked at the one behind its own end: one character earlier is the safe start.
        first, _ = self._find(max(at - 2, 0))
        inside = at - self._before(first)
        last, _ = self._find(min(at + cut, self.n_chars))
        old = "".join(self.leaves[first : last + 1])
        changed = old[:inside] + put + old[inside + cut :]
        size = len(self.leaves)
        while True:
            # The pattern looks two characters ahead at most; so much of what follows is shown.
            behind, ahead = last + 1, ""
            while behind < size and len(ahead) < 2:
                ahead += self.leaves[behind]
                behind += 1
            pieces, end = [], 0
            for found in self.counter.split.finditer(changed + ahead):
                if found.start() >= len(changed):
                    break
                pieces.append(found.group())
                end = found.end()
            self.reencoded += len(changed)
            if end == len(changed):
                break
            changed, last = changed + ahead, behind - 1
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._set(leaf, "", 0)
        if len(pieces) > LEAF * GROWN * (last - first + 1):
            self.leaves[first] = changed
            self._build(self.text())
        else:
            self._set(first, changed, sum(map(self.counter.count, pieces)))

    def _before(self, leaf: int) -> int:
        """Characters in the leaves before one."""
        node, total = self.width + leaf, 0
        while node > 1:
            if node % 2:
                total += self.chars[node - 1]
            node //= 2
        return total


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    lines = Path(path).read_bytes().split(b"\n")
    return {base64.b64decode(word): int(rank) for word, _, rank in (x.partition(b" ") for x in lines if x)}


def with_token_counts(docs: DataFrame, edits: Column, ranks: str = RANKS, text: str = "text") -> DataFrame:
    """The rows with tokens before and after their edits.

    ``edits`` is an array of structs ``at``, ``cut``, ``put``: from character ``at`` on, ``cut``
    characters give way to ``put``. ``reencoded_chars`` is what was split anew for the edits.
    """
    known = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    names = [c.split()[0] for c in COUNTS.split(", ")]

    @F.pandas_udf(COUNTS)
    def counted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = Counter(known.value)
        for texts, changes in batches:
            rows = []
            for text, edits in zip(texts, changes, strict=True):
                tree = CountTree(text or "", counter)
                before = tree.n_chars, tree.n_tokens
                for edit in edits if edits is not None else ():
                    tree.edit(edit["at"] or 0, edit["cut"] or 0, edit["put"] or "")
                rows.append((*before, tree.n_chars, tree.n_tokens, tree.reencoded))
            yield pd.DataFrame(rows, columns=names)

    return (
        docs.withColumn("__counts", counted(F.col(text), edits.cast(EDITS)))
        .withColumns({name: F.col(f"__counts.{name}") for name in names})
        .drop("__counts")
    )


def sample_edits() -> Column:
    """The query's edits, made from each document itself: cut, insert, replace.

    16 characters from a quarter of the text on go; in the middle of the rest the language and
    source come in; at three quarters of that, 24 characters give way to the text's first 24.
    """
    n = F.char_length(F.coalesce("text", F.lit("")))
    name = F.concat(F.coalesce("lang", F.lit("")), F.lit(" "), F.coalesce("source", F.lit("")))

    def edit(share: float, cut: int, put: Column) -> Column:
        return F.struct(
            F.floor(n * share).cast("int").alias("at"), F.lit(cut).alias("cut"), put.cast("string").alias("put")
        )

    first = F.substring(F.coalesce("text", F.lit("")), 1, 24)
    return F.array(edit(0.25, 16, F.lit("")), edit(0.5, 0, name), edit(0.75, 24, first))


def token_report(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """What the query returns."""
    counted = with_token_counts(docs.select("doc_id", "text", "lang", "source"), sample_edits(), ranks)
    return counted.drop("text", "lang", "source")
