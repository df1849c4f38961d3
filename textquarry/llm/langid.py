"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of a sample of labelled text. A text is
parsed from left to right into the longest phrases that occur in the sample;
phrases times the logarithm of the sample's size, over the text's length,
estimates the cross entropy (Ziv and Merhav, 1993). The least wins.

The automata are kept sparse, as one table in which a state's transitions lie
from an offset of its own on, which stands for the state (a double array): its
size follows the samples, not the number of letters, and a step is one look-up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.runtime import SLICE_CHARS, keyed_text, map_texts

#: The sample of a language: so many labelled rows at most, each whole, and no further one once there are so many symbols.
#: Rows with more characters than that are learned from only where a language has no shorter ones.
SAMPLE_ROWS, SAMPLE_SYMBOLS = 32, 24_000
#: Labelled rows of each language that aren't learned from but tell what is foreign to it.
APART_ROWS = 16
#: Symbols of all languages' rows together, in turn, by which foreign texts are told; languages that are left out of them in turn to see what foreign is.
POOL_SYMBOLS, LEFT_OUT = 100_000, 4
#: Bytes of tables that may be broadcast; about 1 MB a language is usual.
MOST_BYTES = 512 << 20
#: Symbols of a text that are parsed in one go; what is found does not depend on it.
BLOCK = 1024
#: Blocks that are parsed at once.
AT_ONCE = 1500
#: Texts with fewer symbols say too little to be called foreign.
FEW_SYMBOLS = 100
UND = "und"

#: 0: a letter of no sample; 1: blank; 2: between two texts of a sample, in no text; letters follow.
UNKNOWN, BLANK, BORDER = 0, 1, 2


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of the lower-cased text; each run of non-letters is one blank."""
    codes = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    blank = codes == BLANK
    return codes[~(blank & np.concatenate(([True], blank[:-1])))]


def automaton(line: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of a line of symbols; state 0 is the root."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in line:
        now = len(after)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = now
            p = link[p]
        if p >= 0:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(after)
                after.append(dict(after[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return after


def double_array(after: list[dict[int, int]], width: int, tries: int = 16) -> np.ndarray:
    """Cells of the automaton's transitions: the offset of the state that owns the cell, and that of the state it leads to, as two rows; -1 where free.

    A state's transition by c is in cell offset + c. Offsets are the states'
    own, but for those without transitions, which share one; the root's is
    WIDTH. States of several transitions come first, at one of ``tries``
    places after the last one's or at the end; single ones fill the holes.
    """
    owner, to = [-1] * (3 * width + tries), [0] * (3 * width + tries)
    offset, taken = [0] * len(after), {width}
    hint, free, top = width, 2 * width, width  # cells from top on are free
    for state in sorted(range(len(after)), key=lambda s: (s > 0, -len(after[s]))):
        codes = list(after[state])
        if not codes:
            continue
        if state == 0:
            at = width
        elif len(codes) > 1:
            for at in range(hint, hint + tries):
                if at not in taken and all(owner[at + c] < 0 for c in codes):
                    break
            else:
                at = top
            hint = at
        else:
            while owner[free] >= 0 or free - codes[0] in taken:
                free += 1
            at = free - codes[0]
        offset[state] = at
        taken.add(at)
        for c, target in after[state].items():
            owner[at + c], to[at + c] = at, target
        top = max(top, at + max(codes) + 1)
        if (more := top + 2 * width + tries - len(owner)) > 0:
            more += len(owner) // 2
            owner += [-1] * more
            to += [0] * more
    last = top  # where no state's own cells are
    where = np.array([o if codes else last for o, codes in zip(offset, after, strict=True)], np.int64)
    cells = np.array([owner[: top + width], to[: top + width]], np.int64)
    return np.where(cells[0] >= 0, np.array([cells[0], where[cells[1]]]), -1)


class CrossParser:
    """The automata of all languages in one table, and that of their pool, by which foreign texts are told."""

    def __init__(self, samples: dict[str, list[str]], apart: dict[str, list[str]] | None = None):
        #: All letters of all samples.
        self.alphabet = {c: i for i, c in enumerate(sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}), 3)}
        width, self.langs, self.logs, tables, cells, roots = len(self.alphabet) + 3, [], [], [], 0, []
        codes = self.codes()
        for lang, texts in sorted(samples.items()):
            line = [c for t in texts for c in [*symbols(t, codes).tolist(), BORDER]]
            table = double_array(automaton(line), width)
            tables.append(np.where(table >= 0, table + cells, -1))
            self.langs.append(lang)
            roots.append(width + cells)
            self.logs.append(math.log2(max(2, len(line))))
            cells += table.shape[1]
        self.width, self.roots = width, np.array(roots, np.int64)
        #: The owner of each cell in the upper half, where it leads in the lower one.
        self.cells = np.concatenate([t[0] << 32 | t[1] & 0xFFFFFFFF for t in tables]) if tables else np.zeros(0, np.int64)
        #: Of each language and symbol: the state after it from the root (the root itself if there is none), and whether that is none.
        start = self.cells[self.roots[:, None] + np.arange(width)] if tables else np.zeros((0, width), np.int64)
        self.unknown = ((start >> 32) != self.roots[:, None]).astype(np.int64)
        self.fresh = np.where(self.unknown, self.roots[:, None], start & 0xFFFFFFFF)
        if (size := self.nbytes) > MOST_BYTES:
            raise ValueError(f"the automata take {size} bytes, more than {MOST_BYTES}: learn from fewer or shorter rows")
        #: All languages' samples as one, and the bits a symbol from which on a text is foreign to it.
        self.pool, self.ceiling = None, math.inf
        if apart and len(samples) > 1:
            self.pool = pooled(samples)
            self.ceiling = foreign_from(samples, apart, self.pool)

    @property
    def nbytes(self) -> int:
        return self.cells.nbytes + self.fresh.nbytes + self.unknown.nbytes

    def codes(self) -> np.ndarray:
        """Symbol of each code point."""
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        table = np.where(letters, UNKNOWN, BLANK).astype(np.int32)
        for c, i in self.alphabet.items():
            table[ord(c)] = i
        return table

    def step(self, lang: np.ndarray, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states after one more symbol, phrases that it ends); lang: rows of the languages.

        Where the automaton stops, a phrase ends and the symbol begins the
        next; a symbol that no sample has is a phrase by itself.
        """
        cell = self.cells.take(state + symbol)
        held = (cell >> 32) == state
        at = lang * self.width + symbol
        ended = np.where(held, 0, (state != self.roots.take(lang)) + self.unknown.take(at))
        return np.where(held, cell & 0xFFFFFFFF, self.fresh.take(at)), ended

    def phrases(self, lines: list[np.ndarray]) -> np.ndarray:
        """Phrases of each line by each language; AT_ONCE blocks of lines are parsed at a time, which bounds memory."""
        out = np.zeros((len(lines), len(self.roots)), np.int64)
        some: list[int] = []
        size = 0

        def settle(which: list[int]) -> None:
            count, ends = self.parse([lines[i] for i in which], None)
            out[which] = (count + (ends != self.roots[:, None])).T

        for i, line in enumerate(lines):
            blocks = -(-len(line) // BLOCK)
            if blocks > AT_ONCE:
                ends = None
                for start in range(0, len(line), AT_ONCE * BLOCK):
                    count, ends = self.parse([line[start : start + AT_ONCE * BLOCK]], ends)
                    out[i] += count[:, 0]
                out[i] += ends[:, 0] != self.roots
                continue
            if some and size + blocks > AT_ONCE:
                settle(some)
                some, size = [], 0
            some.append(i)
            size += blocks
        if some:
            settle(some)
        return out

    def parse(self, lines: list[np.ndarray], before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(phrases that end within each line, state after it), a row for each language; before: states from which the one line there is begins.

        Lines are parsed in blocks, all at once, each as if a phrase began
        with it. Then each block is parsed again from the state in which the
        one before it ended, until both parses are in one state, from where on
        they are the same; where that is not before the block's end, the next
        block follows.
        """
        owner = np.concatenate([np.full(-(-len(x) // BLOCK), i) for i, x in enumerate(lines)] or [np.zeros(0, int)]).astype(np.int64)
        blocks = [x[i : i + BLOCK] for x in lines for i in range(0, len(x), BLOCK)]
        sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
        height = int(sizes.max(initial=0))
        grid = np.zeros((height, len(blocks)), np.int64)
        for column, x in enumerate(blocks):
            grid[: len(x), column] = x
        order = np.argsort(-sizes, kind="stable")
        active = np.searchsorted(-sizes[order], -np.arange(1, height + 1), side="right")
        roots, every = self.roots[:, None], np.arange(len(self.roots))[:, None]
        state, count = np.repeat(roots, len(blocks), 1), np.zeros((len(self.roots), len(blocks)), np.int64)
        for t in range(height):
            n = active[t]
            state[:, :n], ended = self.step(every, state[:, :n], grid[t].take(order[:n]))
            count[:, :n] += ended
        back = np.argsort(order)
        ends, count = state[:, back], count[:, back]
        alone, extra = ends.copy(), np.zeros_like(count)
        first = np.concatenate(([before is None], owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, bool)
        redo = np.repeat(~first[None, :], len(self.roots), 0)
        while redo.any():
            lang, block = np.nonzero(redo)
            redo[:] = False
            now, free = ends[lang, block - 1], self.roots[lang]
            if before is not None:
                now = np.where(block == 0, before[lang, 0], now)
            more, live, end = np.zeros(len(lang), np.int64), np.arange(len(lang)), alone[lang, block]
            for t in range(BLOCK):
                live = live[now[live] != free[live]]
                over = sizes[block[live]] == t
                end[live[over]] = now[live[over]]
                live = live[~over]
                if not len(live):
                    break
                symbol = grid[t, block[live]]
                now[live], a = self.step(lang[live], now[live], symbol)
                free[live], b = self.step(lang[live], free[live], symbol)
                more[live] += a - b
            else:
                live = live[now[live] != free[live]]
                end[live] = now[live]
            extra[lang, block] = more
            changed = ends[lang, block] != end
            ends[lang, block] = end
            lang, block = lang[changed], block[changed] + 1
            inside = (block < len(blocks)) & ~first[np.minimum(block, len(blocks) - 1)]
            redo[lang[inside], block[inside]] = True
        out = np.zeros((len(self.roots), len(lines)), np.int64)
        for k in range(len(self.roots)):
            np.add.at(out[k], owner, count[k] + extra[k])
        last = np.cumsum(np.bincount(owner, minlength=len(lines))) - 1
        return out, np.where(np.bincount(owner, minlength=len(lines)) > 0, ends[:, last] if len(blocks) else roots, roots)

    def costs(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits a symbol of each text by each language, symbols of each text)."""
        lines = [symbols(t, table) for t in texts]
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        return self.phrases(lines) * np.array(self.logs)[None, :] / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None], table: np.ndarray, pool_table: np.ndarray | None = None) -> list[tuple[str, float, bool]]:
        """(language, 1 - least / second least cross entropy, whether the text is foreign to all languages); of equals, the first by name.

        The second table is the pool's; without it no text but those that
        have no language is foreign.
        """
        named = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.langs else []
        out = [(UND, 0.0, True)] * len(texts)
        if not named:
            return out
        held = [texts[i] or "" for i in named]
        costs, sizes = self.costs(held, table)
        best = np.argmin(costs, axis=1)
        foreign = (self.pool.costs(held, pool_table)[0][:, 0] > self.ceiling) & (sizes >= FEW_SYMBOLS) if self.pool is not None and pool_table is not None else np.zeros(len(held), bool)
        for i, row, k, odd in zip(named, costs, best, foreign.tolist(), strict=True):
            low = np.sort(row)
            out[i] = self.langs[k], round(float(1 - low[0] / low[1]), 6) if len(low) > 1 else 1.0, odd
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray | None]:
        """What predict needs, to be made once in each task."""
        return self.codes(), self.pool.codes() if self.pool is not None else None


def pooled(samples: dict[str, list[str]], without: str | None = None) -> CrossParser:
    """One automaton of all languages' samples: their first rows, then their second ones, until there are POOL_SYMBOLS."""
    rows, size = [], 0
    for k in range(max(map(len, samples.values()))):
        for lang, texts in sorted(samples.items()):
            if lang != without and k < len(texts) and size < POOL_SYMBOLS:
                rows.append(texts[k])
                size += len(texts[k])
    return CrossParser({"": rows})


def foreign_from(samples: dict[str, list[str]], apart: dict[str, list[str]], pool: CrossParser) -> float:
    """Bits a symbol above which a text is foreign to all languages.

    Halfway between what languages' own rows cost by the pool and what the
    rows of a language cost that is left out of it (medians by language; the
    dearest and the cheapest). Texts in several languages are between the
    pool's own: each phrase is found in one of them.
    """
    own, other = [], []
    for lang in sorted(samples):
        texts = apart.get(lang, [])
        if texts:
            own.append(float(np.median(pool.costs(texts, pool.codes())[0])))
            if len(other) < LEFT_OUT:
                rest = pooled(samples, lang)
                other.append(float(np.median(rest.costs(texts, rest.codes())[0])))
    return (max(own) + min(other)) / 2 if other and min(other) > max(own) else math.inf


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """(texts to learn from, texts kept apart) by language: whole labelled rows that aren't held out, in the order of a hash of id and text.

    Counts by language come first; a hash threshold then leaves about four
    times the rows wanted, so that what reaches the driver is bounded: rows of
    at most SAMPLE_SYMBOLS characters, and the shortest one of a language
    that has no others.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    size, fits = F.char_length("text"), F.char_length("text") <= SAMPLE_SYMBOLS
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_if(fits).alias("n")).collect()}
    if not counts:
        return {}, {}
    whole, wanted = 1 << 30, 4 * (SAMPLE_ROWS + APART_ROWS)
    rank = F.pmod(F.xxhash64("doc_id", "text"), F.lit(whole))
    upto = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, whole if n <= wanted else math.ceil(whole * wanted / n))])
    picked = rows.where(fits & (rank < upto[F.col("lang")])).select("lang", rank.alias("rank"), "text").collect()
    out: dict[str, list[str]] = {}
    apart: dict[str, list[str]] = {}
    held: dict[str, int] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["rank"], r["text"])):
        lang, n = r["lang"], held.get(r["lang"], 0)
        if n < SAMPLE_SYMBOLS and len(out.get(lang, [])) < SAMPLE_ROWS:
            out.setdefault(lang, []).append(r["text"])
            held[lang] = n + len(r["text"])
        elif r["text"] not in out[lang] and len(apart.get(lang, [])) < APART_ROWS:
            apart.setdefault(lang, []).append(r["text"])
    if only := [lang for lang, n in counts.items() if not n]:
        shortest = rows.where(F.col("lang").isin(only)).groupBy("lang").agg(F.min(F.struct(size.alias("size"), "text")).alias("one"))
        out |= {r["lang"]: [r["text"]] for r in shortest.select("lang", "one.text").collect()}
    return out, apart


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> CrossParser:
    return CrossParser(*sample(docs, id_col, text_col, lang_col))


def identify(docs: DataFrame, parser: CrossParser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1), is_foreign of every row.

    ``und`` with score 0 for null texts, texts without a letter, and where
    nothing was learned. is_foreign: the text has no language, or is foreign
    to all of them (see ``foreign_from``). Whole texts are parsed; labels and
    other columns are not looked at. No shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(parser)

    def make():
        model = held.value
        tables = model.tables()

        def work(ids: list, texts: list) -> dict:
            found = model.predict(texts, *tables)
            return {"doc_id": ids, "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "is_foreign": [x[2] for x in found]}

        return work

    found = map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, lang_pred string, score double, is_foreign boolean")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "is_foreign")


def keep_identified(docs: DataFrame, parser: CrossParser, asked: set[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows whose predicted language is asked for (None: any learned one) and to which their text is not foreign.

    A null label is filled with the prediction, where there is such a column
    of strings. Other columns and labels stay; ``und`` goes. No shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(parser)
    at = docs.columns.index(text_col)
    label = docs.columns.index(lang_col) if lang_col in docs.columns and docs.schema[lang_col].dataType.typeName() == "string" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        model = held.value
        tables = model.tables()
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            borders = [0, *(np.flatnonzero(np.diff(ends // SLICE_CHARS)) + 1).tolist(), batch.num_rows]
            for a, b in zip(borders, borders[1:], strict=False):
                part = batch.slice(a, b - a)
                found = model.predict(part.column(at).to_pylist(), *tables)
                if label is not None:
                    filled = pc.coalesce(part.column(label), pa.array([x[0] for x in found], part.column(label).type))
                    part = part.set_column(label, part.schema.field(label), filled)
                yield part.filter(pa.array([lang != UND and not foreign and (asked is None or lang in asked) for lang, _, foreign in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
