"""Walks along the tokens of many statements at once.

The lexer is a JVM expression (``functions.text.sql_pieces``).  What follows it,
features, neighbours, bracket depth, scope and clause of every token, is worked
out here over Arrow batches: the tokens of all statements of a batch lie in flat
numpy arrays, one element each, and every step is one pass over them.  No Python
runs per row or per token, but for the distinct tokens of a batch.

Statements are independent of each other and of the batch they come in.  A batch
is taken by parts of about ``TOKENS`` tokens (one statement at least), so memory
follows the longest statement, not the batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..functions.text import SQL_KEYWORDS
from ..session import ship_package

#: Tokens that are walked along at once.
TOKENS = 1 << 19
#: Clause words that are none, and TABLE where it names tables, as ``kw`` has them.
SPECIAL = ("IS DISTINCT FROM", "DISTINCT ON", "UPDATE OPTION", "TABLE LIST", "TABLE NAME")
_KEYWORDS = frozenset(SQL_KEYWORDS)


def _bare(piece: str) -> str:
    """A piece of ``functions.text.sql_pieces`` without the white space behind its token."""
    return piece.partition("\n")[0] if piece.startswith("--") else piece.rstrip()


def _is_word(head: int, alone: bool) -> bool:
    r"""Whether a token that starts with this code point is one of ``[\p{L}\p{N}_]+``."""
    if head < 128:
        return chr(head).isalnum() or head == 95
    # no other token of several characters starts beyond ASCII
    return not alone or unicodedata.category(chr(head))[0] in "LN"


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


class Walk:
    """The significant tokens (no white space, no comments) of a batch of statements.

    ``lexed``: each statement's texts, each the list of its pieces (``functions.text.sql_pieces``).
    Arrays have an element per token, statement after statement; where a statement has several
    texts, its tokens are ordered by position.  A token's neighbours are those of
    its own text.  Places of tokens are numbers into these arrays, ``n`` being none;
    words (``up``, ``kw``) are numbers, -1 being none."""

    def __init__(self, lexed: pa.Array):
        texts = lexed.flatten()
        n_texts, n_pieces = (np.asarray(pc.list_value_length(x)).astype(np.int64) for x in (lexed, texts))
        coded = texts.flatten().dictionary_encode()
        piece, pieces = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
        bare = [_bare(p) for p in pieces]
        numbered: dict[str, int] = {}
        token_of = np.fromiter((numbered.setdefault(t, len(numbered)) for t in bare), np.int64, len(bare))
        spaced = np.fromiter((len(t) < len(p) for t, p in zip(bare, pieces)), bool, len(bare))
        code, uniq = token_of[piece], list(numbered)
        heads = np.fromiter((ord(t[0]) for t in uniq), np.int64, len(uniq))
        alone = np.fromiter((len(t) == 1 for t in uniq), bool, len(uniq))
        ups = [t.upper() for t in uniq]
        self.words: dict[str, int] = {}
        word_of = np.fromiter((self.words.setdefault(u, len(self.words)) for u in ups), np.int64, len(uniq))
        for w in SPECIAL:
            self.words.setdefault(w, len(self.words))
        comment = ~alone & np.isin(heads, [45, 47])  # -- and /*
        is_word = np.fromiter(map(_is_word, heads.tolist(), alone.tolist()), bool, len(uniq))
        digit = (heads >= 48) & (heads <= 57)
        quoted = ((heads == 34) | (heads == 96)) & ~alone
        reserved = np.fromiter((u in _KEYWORDS for u in ups), bool, len(uniq))
        self._is_id = (is_word & ~reserved & ~digit) | quoted
        self._literal, self._quote = digit | (heads == 39), heads == 39
        self._texts_of = pa.array(uniq, pa.string())
        self._names = pa.array([(t[1:-1] if q else t).lower() for t, q in zip(uniq, quoted.tolist())], pa.string())

        kept = np.flatnonzero(~comment[code])
        text = np.repeat(np.arange(len(texts)), n_pieces)[kept]
        self.n, self.statements = len(kept), len(lexed)
        before = _starts(spaced[piece])  # positions count white space, too
        first = _starts(n_pieces)[text]
        self.pos = kept + before[kept] - first - before[first]
        self.i = np.arange(self.n) - _starts(np.bincount(text, minlength=len(texts)))[text]
        self.st = np.repeat(np.arange(len(lexed)), n_texts)[text]
        self.tok = np.append(code[kept], -1)
        self._near = {k: self._shifted(text, k) for k in (-2, -1, 1, 2, 3, 4)}
        self.up = np.append(word_of[code[kept]], -1)
        self.kw = self._clause_words()
        if (n_texts > 1).any():
            self._by_position(np.flatnonzero((n_texts > 1)[self.st]))
        counts = np.bincount(self.st, minlength=self.statements)
        self.offsets = _starts(counts)
        self.some = np.flatnonzero(counts > 0)
        self.is_id = self._of_token(self._is_id)

    def _of_token(self, of_distinct: np.ndarray) -> np.ndarray:
        """A feature of distinct tokens for each token; False for none."""
        return np.append(of_distinct, False)[self.tok]

    def _shifted(self, text: np.ndarray, by: int) -> np.ndarray:
        at = np.arange(self.n) + by
        ok = (at >= 0) & (at < self.n)
        at[~ok] = 0
        ok &= text[at] == text if self.n else ok
        return np.where(ok, at, self.n)

    def near(self, by: int) -> np.ndarray:
        """The place of each token's neighbour; of the token itself for 0."""
        return self._near[by] if by else np.arange(self.n)

    def among(self, words: np.ndarray, *names: str) -> np.ndarray:
        """Where the word is one of ``names``; False where there is none."""
        hit = np.zeros(len(self.words) + 1, bool)
        hit[[self.words[w] for w in names if w in self.words]] = True
        return hit[words]

    def _clause_words(self) -> np.ndarray:
        """``up``, but where a clause word is none or TABLE names tables."""
        up, p1, p2 = self.up[:-1], self.up[self.near(-1)], self.up[self.near(-2)]
        kw, free = up.copy(), np.ones(self.n, bool)

        def put(name: str, cond: np.ndarray) -> None:
            kw[cond & free] = self.words[name]
            free[cond] = False
        put("IS DISTINCT FROM", self.among(up, "FROM") & self.among(p1, "DISTINCT") & self.among(p2, "IS", "NOT"))
        put("DISTINCT ON", self.among(up, "ON") & self.among(p1, "DISTINCT"))
        explained = self.among(p1, "ANALYZE", "VERBOSE", "EXTENDED") & self.among(p2, "EXPLAIN", "ANALYZE")
        put("UPDATE OPTION", self.among(up, "UPDATE") & (p1 >= 0) & ~self.among(p1, ")", ";", "EXPLAIN") & ~explained)
        put("TABLE LIST", self.among(up, "TABLE") & (self.among(p1, "DROP", "TRUNCATE") | (self.among(p1, "TEMPORARY") & self.among(p2, "DROP"))))
        put("TABLE NAME", self.among(up, "TABLE") & self.among(p1, "ALTER"))
        return np.append(kw, -1)

    def _by_position(self, these: np.ndarray) -> None:
        """Puts the tokens ``these``, of statements with several texts, in order of
        their position, then of what else is known of them."""
        def ranks(values: list) -> np.ndarray:
            out = np.empty(len(values) + 1, np.int64)
            out[sorted(range(len(values)), key=values.__getitem__)] = np.arange(len(values))
            out[-1] = -1  # none comes first
            return out
        tok, kw = ranks(self._texts_of.to_pylist())[self.tok], ranks(list(self.words))[self.kw]
        is_id = self._of_token(self._is_id)
        keys = [self.st, self.pos, self.i, tok, kw, kw[self.near(-1)], kw[self.near(-2)], is_id[self.near(-1)]]
        for k in (1, 2, 3, 4):
            keys += [tok[self.near(k)], kw[self.near(k)]]
        order = np.arange(self.n)
        order[these] = these[np.lexsort([k[these] for k in reversed(keys)])]
        at = np.append(np.empty(self.n, np.int64), self.n)
        at[order] = np.arange(self.n)
        self.pos, self.i, self.st = self.pos[order], self.i[order], self.st[order]
        ends = np.append(order, self.n)
        self.tok, self.up, self.kw = self.tok[ends], self.up[ends], self.kw[ends]
        self._near = {k: at[v[order]] for k, v in self._near.items()}

    # --- levels, scopes and blocks -------------------------------------------

    @cached_property
    def cum(self) -> np.ndarray:
        """Open brackets after each token; a bracket that opens counts itself."""
        delta = self.delta
        total = np.cumsum(delta)
        return total - (total - delta)[self.offsets[:-1][self.some]].repeat(np.diff(self.offsets)[self.some]) if self.n else total

    @cached_property
    def delta(self) -> np.ndarray:
        return self.among(self.up[:-1], "(").astype(np.int64) - self.among(self.up[:-1], ")")

    @cached_property
    def depth(self) -> np.ndarray:
        return self.cum - self.among(self.up[:-1], "(")

    @cached_property
    def _levels(self) -> dict:
        """Tokens in order of (statement, level): their places, which of them start a
        level or a scope, each scope's first and its number."""
        span = np.int64(self.cum.max() - self.cum.min() + 1) if self.n else 1
        order = np.argsort(self.st * span + (self.cum - self.cum.min()), kind="stable") if self.n else np.zeros(0, np.int64)
        st, cum, opens = self.st[order], self.cum[order], self.among(self.up[order], "(")
        level = np.append([True], (st[1:] != st[:-1]) | (cum[1:] != cum[:-1]))[:self.n]
        scope = level | opens
        return {"order": order, "level": level, "opens": opens, "scope": scope, "first": np.flatnonzero(scope), "nth": np.cumsum(scope) - 1}

    def _back(self, values: np.ndarray) -> np.ndarray:
        """Values in order of levels, put in order of tokens."""
        out = np.empty_like(values)
        out[self._levels["order"]] = values
        return out

    @cached_property
    def scope(self) -> np.ndarray:
        """The how manieth bracket that opened the token's level it is in."""
        v = self._levels
        total = np.cumsum(v["opens"])
        return self._back(total - (total - v["opens"])[v["level"]][np.cumsum(v["level"]) - 1])

    def _last(self, words: tuple, own: bool) -> tuple:
        """Of each token of the levels: the last place there in its scope, up to it
        (``own``) or before it, that has one of ``words``, and whether there is one."""
        v = self._levels
        last = np.maximum.accumulate(np.where(self.among(self.kw[v["order"]], *words), np.arange(self.n), -1)) if self.n else np.zeros(0, np.int64)
        if not own:
            last = np.append([-1], last)[:self.n]
        return last, last >= v["first"][v["nth"]]

    def clause_of(self, words: tuple) -> np.ndarray:
        """The last of ``words`` in the token's scope, itself included; -1 for none."""
        last, ok = self._last(words, own=True)
        return self._back(np.where(ok, self.kw[self._levels["order"]][last] if self.n else last, -1))

    def seen(self, *words: str) -> np.ndarray:
        """Whether one of ``words`` comes earlier in the token's scope."""
        return self._back(self._last(words, own=False)[1])

    def blocks(self) -> dict:
        """Each token's bracket (``slo``, ``shi``) and block (``lo``, ``hi``) as least and
        greatest token number: a block goes from a SELECT or semicolon to the next one of
        its bracket, the tokens before the first have the whole bracket."""
        if not self.n:
            return dict.fromkeys(("slo", "shi", "lo", "hi"), np.zeros(0, np.int64))
        v, i = self._levels, self.i[self._levels["order"]]
        starts = self.among(self.kw[v["order"]], "SELECT", ";")
        cuts = v["scope"] | starts
        first, nth = np.flatnonzero(cuts), np.cumsum(cuts) - 1
        slo, shi = (f.reduceat(i, v["first"])[v["nth"]] for f in (np.minimum, np.maximum))
        lo, hi = (f.reduceat(i, first)[nth] for f in (np.minimum, np.maximum))
        total = np.cumsum(starts)
        whole = total == (total - starts)[v["first"]][v["nth"]]
        return {"slo": self._back(slo), "shi": self._back(shi), "lo": self._back(np.where(whole, slo, lo)), "hi": self._back(np.where(whole, shi, hi))}

    # --- results ---------------------------------------------------------------

    def texts(self, at: np.ndarray) -> pa.Array:
        """The tokens at these places."""
        return self._texts_of.take(_or_null(self.tok[at]))

    def names(self, at: np.ndarray) -> pa.Array:
        """Names at these places: lower-cased, quotes removed."""
        return self._names.take(_or_null(self.tok[at]))

    def word(self, words: np.ndarray) -> pa.Array:
        return self._word_list.take(_or_null(words))

    @cached_property
    def _word_list(self) -> pa.Array:
        return pa.array(list(self.words), pa.string())

    def literal(self, at: np.ndarray) -> np.ndarray:
        """Whether a number or string literal is there."""
        return self._of_token(self._literal)[at]

    def quote(self, at: np.ndarray) -> np.ndarray:
        return self._of_token(self._quote)[at]

    def lists(self, at: np.ndarray, values: pa.Array) -> pa.Array:
        """Per statement the list of ``values``, which are those of the places ``at`` (in order)."""
        offsets = _starts(np.bincount(self.st[at], minlength=self.statements))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    def numbers(self, of_some: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
        """Numbers of the statements that have tokens; null for the others and where ``none``."""
        out, gone = np.zeros(self.statements, np.int64), np.ones(self.statements, bool)
        out[self.some], gone[self.some] = of_some, False if none is None else none
        return pa.array(out, pa.int64(), mask=gone)

    def words_of(self, at_some: np.ndarray) -> pa.Array:
        """The upper-cased tokens at one place for each statement that has tokens; null for the others."""
        out = np.full(self.statements, -1)
        out[self.some] = self.up[at_some]
        return self.word(out)

    def first_place(self, cond: np.ndarray) -> np.ndarray:
        """Of the statements that have tokens, the place of the first one with ``cond``; ``n`` for none."""
        return np.minimum.reduceat(np.where(cond, np.arange(self.n), self.n), self.offsets[self.some]) if self.n else np.zeros(0, np.int64)

    def last_place(self, cond: np.ndarray) -> np.ndarray:
        found = np.maximum.reduceat(np.where(cond, np.arange(self.n), -1), self.offsets[self.some]) if self.n else np.zeros(0, np.int64)
        return np.where(found < 0, self.n, found)


def structs(**fields) -> pa.Array:
    """Structs of these fields: Arrow arrays, or numpy arrays of long and boolean values."""
    return pa.StructArray.from_arrays([f if isinstance(f, pa.Array) else pa.array(f) for f in fields.values()], names=list(fields))


def ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _or_null(codes: np.ndarray) -> pa.Array:
    return pa.array(codes, pa.int64(), mask=codes < 0)


def _parts(batch: pa.RecordBatch, lexed: int) -> Iterator[pa.RecordBatch]:
    """The batch by parts of about ``TOKENS`` tokens."""
    column = batch.column(lexed)
    per_text = np.asarray(pc.list_value_length(column.flatten())).astype(np.int64)
    upto = _starts(per_text)[_starts(np.asarray(pc.list_value_length(column)))]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + TOKENS, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def walked(lexed: DataFrame, made: str, columns: Callable[[pa.Array], list]) -> DataFrame:
    """``lexed`` with its last column (each statement's texts as lists of pieces) replaced
    by what ``columns`` makes of it, ``made`` being the names and types of that."""
    ship_package(lexed.sparkSession)
    names, last = lexed.columns[:-1], len(lexed.columns) - 1
    out = StructType(lexed.schema.fields[:-1] + StructType.fromDDL(made).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, last):
                arrays = [part.column(k) for k in range(last)] + columns(part.column(last))
                yield pa.RecordBatch.from_arrays(arrays, names=names + [f"_{k}" for k in range(len(arrays) - last)])
    return lexed.mapInArrow(run, out)
