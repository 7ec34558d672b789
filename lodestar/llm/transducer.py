"""Token counts by compiled finite-state transducers.

The word vocabulary merges symbols (bytes; a word's last byte carries an end
mark).  A merge tokenisation is the only split whose neighbouring tokens are
each compatible (their own text splits into just the two), so reading a word
left to right needs, for the last few places, only the token that ends there
and the count so far.  That is a finite state; transitions are annotated with
the change of the token count and compiled when first taken.

Some places end a word in every state: white space, the sides of a digit, a
letter before punctuation.  So a chunk of text maps each entry state to an exit
state in a compact form: the part before its first such place (which depends on
the entry), the tokens of the words inside, and the part after its last one
(the exit).  Such maps compose associatively.  A long text is cut into chunks
anywhere, the chunks are mapped in parallel, and ``FAN`` neighbouring maps at a
time are combined, in as many rounds as that takes: no task holds all maps of a
text.  A single word longer than chunks is all head and travels as text.

Defined results: null text -> 0 bytes, 0 tokens; special strings inside a text
are one token each, as the library counts them by default; very long texts are
counted whole; repeated rows are counted each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import utf8_bytes
from lodestar.session import stage

VOCABULARY = "word_bpe_49k.json"
CHUNK_CHARS = 1 << 15
FAN = 16  # chunk maps combined at a time
LIMIT = 2048
MEMO = 600_000  # words kept per task
STATES = 400_000  # transitions kept per task

# The vocabulary file's special strings and pre-token pattern,
# with white space as the Unicode property (Python's \s also takes \x1c-\x1f).
SPECIAL = re.compile(r"<\|startoftext\|>|<\|endoftext\|>")
_SPACE = "\t-\r \x85\xa0  -     　"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
GENERAL = rf"{_SHORT}|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
# the same for texts within the first 256 code points, after lower-casing
_L, _N, _S = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_LATIN = re.compile(f"{_SHORT}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BREAK = re.compile(f"[{_SPACE}]")
# where a word ends without white space, before a character that never joins
# the one before it: at a digit, and from a letter to punctuation
_ENDS = re.compile(r"(?<=[0-9])(?=[\x21-\x7e])|(?<=.)(?=[0-9])|(?<=[A-Za-z\u4e00-\u9fff])(?=[!-/:-@\[-`{-~\u3001-\u3003\uff01-\uff0f])")
_SPECIAL_MOST = 15  # characters of the longest special string


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in keep}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)})
    return out


class WordTransducer:
    """Counts the tokens of one word (its UTF-8 bytes)."""

    def __init__(self, vocabulary: str, most: int = STATES):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end, byte = model["end_of_word_suffix"], byte_symbols()

        def symbols(token: str) -> str:
            """One character per symbol: chr(byte), + 256 for a word's last."""
            last = token.endswith(end) and len(token) > len(end)
            body = [byte[c] for c in (token[: -len(end)] if last else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + 256 * last)

        pairs = [tuple(map(symbols, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self._rank = {p: i for i, p in reversed(list(enumerate(pairs)))}
        self._tokens = {chr(b) for b in range(512)} | {a + b for a, b in pairs}
        self._heads = {t[:i] for t in self._tokens for i in range(len(t))}
        self._fits: dict[tuple[str, str], bool] = {}
        self._most = most
        self._reset()

    def _reset(self) -> None:
        # a state: the longest suffix that a token can continue, and for each
        # place in it (and before it) the last token there and the count
        # relative to the state's own
        start = ("", ("",), (0,))
        self._states, self._ids = [start], {start: 0}
        self._step: dict[int, tuple[int, int]] = {}
        self._last: dict[int, int] = {}

    def split(self, word: str) -> list[str]:
        """Tokens of a symbol string by merges, lowest rank first."""
        parts = list(word)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self._rank.get((parts[i], parts[i + 1]), 1 << 30))
            pair = (parts[best], parts[best + 1])
            if pair not in self._rank:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def _compatible(self, a: str, b: str) -> bool:
        fits = self._fits.get((a, b))
        if fits is None:
            fits = self._fits[(a, b)] = self.split(a + b) == [a, b]
            if len(self._fits) > self._most:
                self._fits.clear()
        return fits

    def _emit(self, state: int, symbol: str) -> tuple[str, int]:
        """The token that ends with the symbol, and the change of the count."""
        suffix, tokens, counts = self._states[state]
        text = suffix + symbol
        for j in range(len(text)):
            token = text[j:]
            if token in self._tokens and (not tokens[j] or self._compatible(tokens[j], token)):
                return token, counts[j] + 1
        raise AssertionError("a single symbol is always a token")

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        suffix, tokens, counts = self._states[state]
        token, change = self._emit(state, chr(byte))
        text = suffix + chr(byte)
        cut = next(i for i in range(len(text) + 1) if text[i:] in self._heads)
        new = (text[cut:], (*tokens, token)[cut:], (*(c - change for c in counts), 0)[cut:])
        at = self._ids.get(new)
        if at is None:
            at = self._ids[new] = len(self._states)
            self._states.append(new)
        self._step[state << 8 | byte] = found = (at, change)
        return found

    def count(self, word: bytes) -> int:
        if len(self._step) > self._most:
            self._reset()
        step, state, total = self._step, 0, 0
        for b in word[:-1]:
            move = step.get(state << 8 | b) or self._compile(state, b)
            state = move[0]
            total += move[1]
        key = state << 8 | word[-1]
        last = self._last.get(key)
        if last is None:
            last = self._last[key] = self._emit(state, chr(word[-1] + 256))[1]
        return total + last


class _Words(dict):
    def __init__(self, count, most: int):
        super().__init__()
        self._count, self._most = count, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self._most:
            self.clear()
        n = self._count(word.encode())
        if len(word) <= 64:
            self[word] = n
        return n


class TextTransducer:
    """Counts of texts and chunk maps, over a word transducer."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import regex

        self._words = _Words(WordTransducer(public_tokenizers.path(vocabulary)).count, MEMO)
        self._general = regex.compile(GENERAL)

    def _plain(self, text: str) -> int:
        try:
            text.encode("latin-1")
            return sum(map(self._words.__getitem__, _LATIN.findall(text.lower())))
        except UnicodeEncodeError:
            # capital sigma has no word-final form here
            low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return sum(map(self._words.__getitem__, self._general.findall(low)))

    def count(self, text: str) -> int:
        if "<|" in text:
            parts = SPECIAL.split(text)
            return sum(map(self._plain, parts)) + len(parts) - 1
        return self._plain(text)

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens inside, tail); None: no place to cut, all is head."""
        found = _BREAK.search(chunk)
        if found:
            first, last = found.start(), len(chunk) - 1
            while not _BREAK.match(chunk, last):
                last -= 1
            last += 1
        else:
            # never within what may be a special string
            cuts = [m.start() for m in _ENDS.finditer(chunk)]
            cuts = [c for c in cuts if c >= _SPECIAL_MOST and "<" not in chunk[c - _SPECIAL_MOST : c]]
            if not cuts:
                return chunk, None, ""
            first, last = cuts[0], cuts[-1]
        return chunk[:first], self.count(chunk[first:last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + b[1] + self.count(a[2] + b[0]), b[2]

    def joined(self, maps: list[tuple]) -> tuple:
        """The map of neighbouring chunks in order."""
        out = maps[0]
        for m in maps[1:]:
            out = self.compose(out, m)
        return out

    def total(self, chunk_map: tuple) -> int:
        """Tokens of a text from the map of all of it."""
        head, inside, tail = chunk_map
        return self.count(head) + (inside or 0) + self.count(tail)


MAP = "doc struct<doc_id:bigint,n:bigint,n_bytes:bigint>, at int, chunks int, head string, inside bigint, tail string"


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    last = F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / chunk_chars).cast("int")
    pieces = F.when(last == 0, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * chunk_chars + 1, F.lit(chunk_chars)))
    )
    # rows are numbered before they are cut into chunks
    doc = F.struct("doc_id", F.monotonically_increasing_id().alias("n"), utf8_bytes("text").alias("n_bytes"))
    cut = docs.select(doc.alias("doc"), F.explode(F.array(pieces)).alias("pieces"))
    chunks = cut.select("doc", F.size("pieces").alias("chunks"), F.posexplode("pieces").alias("at", "chunk"))

    def batch_of(doc, at, chunks, maps):
        import pyarrow as pa

        kinds = (pa.string(), pa.int64(), pa.string())
        cols = [pa.array([m[i] for m in maps], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([doc, at, chunks, *cols], names=["doc", "at", "chunks", "head", "inside", "tail"])

    def run_maps(batches: Iterator) -> Iterator:
        t = TextTransducer(vocabulary)
        for batch in batches:
            whole = [n == 1 for n in batch.column(2).to_pylist()]
            texts = batch.column(3).to_pylist()
            # a text of one chunk is counted at once
            maps = [("", t.count(c), "") if w else t.chunk_map(c) for c, w in zip(texts, whole, strict=True)]
            yield batch_of(batch.column(0), batch.column(1), batch.column(2), maps)

    def run_joins(batches: Iterator) -> Iterator:
        t = TextTransducer(vocabulary)
        for batch in batches:
            maps = [t.joined([(m["head"], m["inside"], m["tail"]) for m in some]) for some in batch.column(3).to_pylist()]
            yield batch_of(batch.column(0), batch.column(1), batch.column(2), maps)

    def run_totals(batches: Iterator) -> Iterator:
        import pyarrow as pa

        t = TextTransducer(vocabulary)
        for batch in batches:
            n = [t.total(m) for m in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.column(0).flatten(), pa.array(n, pa.int64())], names=["doc_id", "n", "n_bytes", "n_tokens"])

    maps = stage(chunks.select("doc", "at", "chunks", "chunk").mapInArrow(run_maps, MAP), "token_maps")
    out = maps.where("chunks = 1").select("doc.doc_id", "doc.n_bytes", F.col("inside").alias("n_tokens"))
    maps = maps.where("chunks > 1")
    most = maps.agg(F.max("chunks").alias("n")).first()["n"] or 1
    while most > 1:
        group = [F.col("doc"), F.floor(F.col("at") / FAN).cast("int").alias("at"), F.ceil(F.col("chunks") / FAN).cast("int").alias("chunks")]
        some = F.sort_array(F.collect_list(F.struct(F.col("at").alias("place"), "head", "inside", "tail"))).alias("maps")  # at most FAN
        maps = maps.groupBy(*group).agg(some).select("doc", "at", "chunks", "maps").mapInArrow(run_joins, MAP)
        maps, most = stage(maps, "token_maps"), -(-most // FAN)
    long = maps.mapInArrow(run_totals, "doc_id long, n long, n_bytes long, n_tokens long")
    return out.unionByName(long.select("doc_id", "n_bytes", "n_tokens"))


def op6_transducer_counts(spark, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
