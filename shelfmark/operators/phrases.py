"""Which search term occurs in which record: the phrase (theta) join.

:func:`term_hits` takes a vocabulary known to the program and folds it into one
expression per row. :func:`phrase_join` takes terms as a DataFrame of any size
and picks, by counting them, among ways that all give the same rows:

* short terms, few: folded into one search per row, with one bit for each phrase, so what
  is shuffled is one row of bits per record;
* short terms, many: their pieces are looked up in the distinct words of the corpus and
  the words that hold each are counted. Pieces that many words hold, such as single
  letters, are folded after all; the others meet the texts at the words that hold them,
  a bounded number for each piece, however large the corpus is;
* phrases of three or more words, of bounded size: broadcast. An inner word of
  the phrase stands alone in any text that holds it, so the text's words meet
  the phrases by an equi-join and the text is checked on the spot. One pass,
  nothing is shuffled;
* phrases beyond that bound: the same join shuffled by word, with the rarest
  inner word as the meeting point, and the candidates checked against the texts. A bitmap
  of fixed size keeps back the words and the texts that no phrase can meet; where it is
  full, all move.

No way compares every text with every phrase. A phrase is searched once, however many
terms it has: terms come in at the end, to records that hold their phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import once
from shelfmark.session import stored

GRAM = 3
MAX_FOLDED = 200
# A piece that more words of the corpus hold is searched in the texts themselves, if it
# is one of the MAX_FREQUENT most frequent. The larger the corpus, the more pieces are.
FEW_WORDS = 1000
MAX_FREQUENT = 1024
# Phrases of such pieces that are searched as they are, not piece first.
MAX_FREQUENT_PHRASES = 2048
# Distinct words that a task holds before it gives them out.
WORDS_HELD = 1 << 19
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Phrases that share a number, a bit each.
BITS = 64
# Bits of the map of words or records, 128 kB.
MAP_BITS = 1 << 20
_ROW_OVERHEAD = 100
_BLANKS = r"\s+"


def _search(phrases: Sequence[str]) -> Callable[[bytes], int]:
    """A function from a text to the bits of the phrases it holds. A phrase of several
    words is searched only where those of its words that are phrases have been found."""
    alone = {p.encode(): 1 << i for i, p in enumerate(phrases) if len(p.encode().split()) == 1}
    longer = [
        (1 << i, p.encode(), reduce(or_, [alone.get(w, 0) for w in p.encode().split()], 0))
        for i, p in enumerate(phrases) if p.encode() not in alone
    ]

    def run(text: bytes) -> int:
        found = 0
        for phrase, bit in alone.items():
            if phrase in text:
                found |= bit
        for bit, phrase, needed in longer:
            if found & needed == needed and phrase in text:
                found |= bit
        return found

    return run


def _folded(docs: DataFrame, known: Sequence[tuple[str, Sequence]], id_type: str) -> DataFrame:
    """(record_id, id), distinct: the ids of each phrase that a text of the record holds."""
    phrases = [p for p, _ in known]
    names = [f"_b{k}" for k in range(-(-len(known) // BITS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, width = _search(phrases), 8 * len(names)
        for batch in batches:
            found = [0 if t is None else search(t) for t in batch.column(1).to_pylist()]
            flat = b"".join(f.to_bytes(width, "little") for f in found)
            bits = np.frombuffer(flat, np.int64).reshape(len(found), len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(bits[:, k]) for k in range(len(names)))],
                names=["record_id", *names],
            )

    own = docs.schema["record_id"].dataType.simpleString()
    marked = docs.select("record_id", F.col("_lowered").cast("binary").alias("text")).mapInArrow(
        run, ", ".join([f"record_id {own}", *(f"{n} long" for n in names)])
    )
    held = (
        marked.filter(reduce(or_, [F.col(n) != 0 for n in names]))
        .groupBy("record_id").agg(*[F.bit_or(n).alias(n) for n in names])
    )
    places = F.filter(
        F.sequence(F.lit(0), F.lit(len(known) - 1)),
        lambda i: F.getbit(F.get(F.array(*names), F.floor(i / BITS).cast("int")), i % BITS) == 1,
    )
    ids = F.array(*[F.array(*[F.lit(t) for t in own]) for _, own in known]).cast(f"array<array<{id_type}>>")
    found = F.array_distinct(F.flatten(F.transform(places, lambda i: F.get(ids, i))))
    return held.select("record_id", F.explode(found).alias("id"))


def term_hits(
    records: DataFrame,
    text: str,
    terms: Sequence[str],
    keep: Sequence[str],
    first_rank: int = 0,
) -> DataFrame:
    """One row per (record, term in its text): ``keep`` + ``term_rank, term``."""
    lowered = once(records.select(*keep, F.col(text).alias("_text")), _lowered=F.lower("_text"))
    hits = [
        F.when(
            F.contains(F.col("_lowered"), F.lit(t.lower())),
            F.struct(F.lit(first_rank + i).alias("term_rank"), F.lit(t).alias("term")),
        )
        for i, t in enumerate(terms)
    ]
    return lowered.select(*keep, F.inline(F.array_compact(F.array(*hits))))


def _words(lowered: Column) -> Column:
    return F.filter(F.split(lowered, _BLANKS), lambda w: w != "")


def _doc_words(docs: DataFrame, asked: Callable[[Column], Column]) -> DataFrame:
    """The distinct words of every text that ``asked`` lets through."""
    words = F.array_distinct(_words(F.col("_lowered")))
    return docs.select("record_id", F.explode(F.filter(words, asked)).alias("word"))


def _map_of(df: DataFrame, column: str) -> Callable[[Column], Column]:
    """Whether a value may be in the column: never false for one that is. The map has
    ``MAP_BITS`` bits, however many values there are."""
    place = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
    # 32 bits a number: the sign is left alone
    bit = F.expr("shiftleft(1L, cast(_place % 32 AS int))")
    rows = (
        df.select(place.alias("_place")).groupBy(F.floor(F.col("_place") / 32).alias("at"))
        .agg(F.bit_or(bit).alias("bits")).collect()
    )
    numbers = [0] * (MAP_BITS // 32)
    for r in rows:
        numbers[r["at"]] = r["bits"]
    # one constant, not one for each number
    held = F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")

    def may_hold(value: Column) -> Column:
        at = F.pmod(F.xxhash64(value), F.lit(MAP_BITS))
        return F.getbit(F.get(held, F.floor(at / 32).cast("int")), (at % 32).cast("int")) == 1

    return may_hold


def _longest(words: Column) -> Column:
    return F.aggregate(
        words, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best)
    )


def _inner(words: str) -> Column:
    """The words between the first and the last, which may be cut ones."""
    return F.slice(words, F.lit(2), F.size(words) - 2)


def _fits(sizes: tuple[int, int], bound: int) -> bool:
    """Whether rows of this number and these bytes may be broadcast."""
    return sizes[1] + sizes[0] * _ROW_OVERHEAD <= bound


def _sizes(df: DataFrame, *columns: str) -> tuple[int, int]:
    """Rows and bytes of the columns."""
    each = reduce(lambda a, b: a + b, [F.octet_length(F.col(c).cast("string")) for c in columns])
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0))).first())


def _met_by_broadcast(docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """Phrases whose total size has been checked: each meets the texts at a word of theirs,
    ``word``. Every task has them all, and a text is split and searched where it is: no
    row is made per word."""
    at = {}
    for r in anchored.select("word", "phrase").collect():
        at.setdefault(r.word.encode(), []).append(r.phrase.encode())
    schema = f"record_id {docs.schema['record_id'].dataType.simpleString()}, phrase string"
    if not at:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = frozenset(at)
        for batch in batches:
            places, phrases = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                # bytes are split at the blanks of _BLANKS
                met = words.intersection(text.split()) if text else ()
                held = {p for w in met for p in at[w] if p in text}
                places += [i] * len(held)
                phrases += held
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64())), *_strings(phrase=phrases).columns],
                names=["record_id", "phrase"],
            )

    texts = docs.select("record_id", F.col("_lowered").cast("binary").alias("text"))
    return texts.mapInArrow(run, schema).distinct()


def _strings(**columns) -> pa.RecordBatch:
    """A batch of strings given as bytes."""
    arrays = [pa.array(list(c), pa.binary()).cast(pa.string()) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _met_by_merge(docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """The same, however many the phrases are."""
    words = _doc_words(docs, _map_of(anchored, "word"))
    found = words.join(anchored.hint("merge"), "word").select("record_id", "phrase")
    return _confirmed(docs, stored(found, "candidates"))


def _confirmed(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose text does hold the phrase. The check is part of the join,
    so no (text, phrase) pair is built; the join has already split its output by
    record, which serves the distinct as well. Texts of records without a candidate stay
    where they are."""
    asked = candidates.withColumnRenamed("record_id", "_record_id")
    holds = F.contains(F.col("_lowered"), F.col("phrase"))
    return (
        docs.filter(_map_of(candidates, "record_id")(F.col("record_id")))
        .join(asked, (F.col("record_id") == F.col("_record_id")) & holds)
        .select("record_id", "phrase")
        .distinct()
    )


def _by_broadcast(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Each phrase at its longest inner word."""
    return _met_by_broadcast(docs, phrases.select("phrase", _longest(_inner("_words")).alias("word")))


def _by_rarest_word(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    inner = stored(
        phrases.select("phrase", F.explode(F.array_distinct(_inner("_words"))).alias("word")), "inner-words"
    )
    # merge joins throughout: exploded sides outgrow the size Spark expects of them, a
    # sort spills, and adaptive execution splits a word that most texts hold. Words are
    # counted before they move
    present = _doc_words(docs, _map_of(inner, "word"))
    counts = present.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))
    anchors = (
        inner.join(counts.hint("merge"), "word", "left")
        .groupBy("phrase")
        # an inner word the corpus lacks settles the matter: no text holds the phrase
        .agg(F.min_by("word", F.struct(F.coalesce("n_docs", F.lit(0)), "word")).alias("word"))
    )
    return _met_by_merge(docs, stored(anchors, "anchors"))


def _grams(word: Column) -> Column:
    """Distinct runs of 1 to ``GRAM`` characters; the lookahead lets them overlap."""
    runs = [
        F.regexp_extract_all(word, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))
        for n in range(1, GRAM + 1)
    ]
    return F.array_distinct(F.flatten(F.array(*runs)))


def _vocabulary(docs: DataFrame) -> DataFrame:
    """The distinct words of all texts. Texts are split inside the tasks, and a word that
    many texts of a task hold leaves it once, not once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(text.split())  # of bytes: at the blanks of _BLANKS
                if len(words) >= WORDS_HELD:
                    yield _strings(word=words)
                    words = set()
        if words:
            yield _strings(word=words)

    texts = docs.filter(F.col("_lowered").isNotNull()).select(F.col("_lowered").cast("binary").alias("text"))
    return texts.mapInArrow(run, "word string").distinct()


def _lookup(pieces: Sequence[str]) -> Callable[[list[bytes]], Iterator[tuple[int, np.ndarray]]]:
    """A function from words to the places of those that hold a piece, for each piece that
    one of them holds. Pieces are found by their first ``GRAM`` bytes at every place of
    the words, so the work does not grow with the pieces that no word holds."""
    known = [p.encode() for p in pieces]
    starts = {n: {} for n in range(1, GRAM + 1)}
    for i, p in enumerate(known):
        n = min(len(p), GRAM)
        starts[n].setdefault(int.from_bytes(p[:n], "big"), []).append(i)
    asked = {n: np.zeros(1 << 8 * n, bool) for n in starts if starts[n]}
    for n, flags in asked.items():
        flags[list(starts[n])] = True
    longest = max(map(len, known), default=0)

    def run(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        # neither words nor pieces have a line break, so nothing is found across words
        buf = np.frombuffer(b"\n".join(words) + b"\n" * (longest + 1), np.uint8)
        ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
        for n, flags in asked.items():
            codes = buf[: len(buf) - n + 1].astype((np.uint8, np.uint16, np.uint32)[n - 1])
            for k in range(1, n):
                codes = (codes << 8) | buf[k : len(buf) - n + 1 + k]
            at = np.flatnonzero(flags[codes])
            order = at[np.argsort(codes[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            for same in np.split(order, cuts) if len(order) else []:
                for i in starts[n][int(codes[same[0]])]:
                    hits = same
                    for k in range(n, len(known[i])):
                        hits = hits[buf[hits + k] == known[i][k]]
                    if len(hits):
                        yield i, np.unique(np.searchsorted(ends, hits, "right"))

    return run


def _counted(vocabulary: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """(piece, n): how many words hold it. What leaves a task are its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, counts = _lookup(pieces), np.zeros(len(pieces), np.int64)
        for batch in batches:
            for i, held in look(batch.column(0).to_pylist()):
                counts[i] += len(held)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([pieces[i] for i in at], pa.string()), pa.array(counts[at])], names=["piece", "n"]
        )

    words = vocabulary.select(F.col("word").cast("binary"))
    return words.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def _holding(vocabulary: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """(piece, word) wherever a word of the corpus holds one of the pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _lookup(pieces)
        for batch in batches:
            words = batch.column(0).to_pylist()
            for i, held in look(words):
                yield _strings(piece=[pieces[i].encode()] * len(held), word=[words[k] for k in held])

    return vocabulary.select(F.col("word").cast("binary")).mapInArrow(run, "piece string, word string")


def _holders(vocabulary: DataFrame, pieces: DataFrame) -> DataFrame:
    """The same, however many the pieces are: found by a gram they share."""
    starts = stored(pieces.withColumn("_gram", F.substring("piece", 1, GRAM)), "piece-starts")
    # a piece shorter than a gram is looked up as it is, so the grams of the
    # corpus words come in all lengths; grams that start no piece are left out
    grams = F.filter(_grams(F.col("word")), _map_of(starts, "_gram"))
    return (
        starts.join(vocabulary.select("word", F.explode(grams).alias("_gram")).hint("merge"), "_gram")
        .filter(F.contains(F.col("word"), F.col("piece")))
        .select("piece", "word")
    )


def _by_vocabulary(docs: DataFrame, short: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """Phrases of one or two words: their longer word, the piece, lies inside a word of
    the text.

    The words that hold a piece are counted. Pieces that many words hold would name nearly
    every text once per word; what has them is folded into one search per text. The
    others come by a join on the words that hold them, ``FEW_WORDS`` at most for each
    piece unless more than ``MAX_FREQUENT`` pieces have more; what is more than its piece
    is confirmed.
    """
    asked = stored(short.select("phrase", _longest(F.col("_words")).alias("piece")), "pieces")
    pieces = asked.select("piece").distinct()
    # stored: neither the words nor what is found in them is made again
    vocabulary = stored(_vocabulary(docs), "vocabulary")
    if _fits(_sizes(pieces, "piece"), max_broadcast_bytes):
        known, holders = [r.piece for r in pieces.collect()], None
        counted = _counted(vocabulary, known)
    else:
        holders = stored(_holders(vocabulary, pieces), "holders")
        counted = holders.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    most = counted.filter(F.col("n") > FEW_WORDS).orderBy(F.desc("n"), "piece").limit(MAX_FREQUENT)
    frequent = [r.piece for r in most.collect()]
    if holders is None:
        rare = _holding(vocabulary, sorted({*known}.difference(frequent)))
    else:
        rare = holders.filter(~F.col("piece").isin(frequent)) if frequent else holders
    anchored = stored(rare.join(asked.hint("merge"), "piece").select("word", "phrase"), "anchors")
    small = _fits(_sizes(anchored, "word", "phrase"), max_broadcast_bytes)
    found = (_met_by_broadcast if small else _met_by_merge)(docs, anchored)
    if not frequent:
        return found
    theirs = asked.filter(F.col("piece").isin(frequent))
    few = [r.phrase for r in theirs.select("phrase").limit(MAX_FREQUENT_PHRASES + 1).collect()]
    if len(few) <= MAX_FREQUENT_PHRASES:
        return found.unionByName(_folded(docs, [(p, [p]) for p in few], "string").withColumnRenamed("id", "phrase"))
    pieces = stored(_folded(docs, [(p, [p]) for p in frequent], "string"), "pieces")
    candidates = pieces.withColumnRenamed("id", "piece").join(theirs.hint("merge"), "piece")
    settled = candidates.filter(F.col("phrase") == F.col("piece")).select("record_id", "phrase")
    open_ones = candidates.filter(F.col("phrase") != F.col("piece")).select("record_id", "phrase")
    return found.unionByName(settled).unionByName(_confirmed(docs, stored(open_ones, "candidates")))


def phrase_join(
    records: DataFrame,
    text: str,
    terms: DataFrame,
    record_id: str,
    term_id: str,
    phrase: str,
    max_folded: int = MAX_FOLDED,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(record_id, term_id) wherever the lower-cased text contains the phrase.

    Rows are distinct whichever way is taken, also where ids repeat; rows and terms
    without an id are left out, and a blank phrase is no phrase. The terms are measured
    when this is called; with many short ones or phrases beyond the bound the words of the
    texts are, too, otherwise the texts are not touched before an action.
    """
    docs = once(
        records.select(F.col(record_id).alias("record_id"), F.col(text).alias("_text"))
        .filter(F.col("record_id").isNotNull()),
        _lowered=F.lower("_text"),
    ).drop("_text")
    asked = stored(
        terms.select(F.col(term_id).alias("term_id"), F.lower(phrase).alias("phrase"))
        .withColumn("_words", _words(F.col("phrase")))
        .filter((F.size("_words") > 0) & F.col("term_id").isNotNull())
        .dropDuplicates(["term_id", "phrase"]),
        "terms",
    )
    short, long = asked.filter(F.size("_words") <= 2), asked.filter(F.size("_words") > 2)
    id_type = asked.schema["term_id"].dataType
    parts, found = [], []

    few = short.select("term_id", "phrase").limit(max_folded + 1).collect()
    if len(few) > max_folded:
        found.append(_by_vocabulary(docs, short.dropDuplicates(["phrase"]), max_broadcast_bytes))
    elif few:
        known = {}
        for r in few:
            known.setdefault(r.phrase, []).append(r.term_id)
        parts.append(_folded(docs, list(known.items()), id_type.simpleString()).withColumnRenamed("id", "term_id"))

    n, size = _sizes(long, "phrase", "phrase", "term_id")
    if n:
        by = _by_broadcast if _fits((n, size), max_broadcast_bytes) else _by_rarest_word
        found.append(by(docs, long.dropDuplicates(["phrase"])))

    if found:
        small = _fits(_sizes(asked, "phrase", "term_id"), max_broadcast_bytes)
        own = asked.select("phrase", "term_id").hint("broadcast" if small else "merge")
        # phrases of a record are distinct, and so are terms of one phrase each
        named = reduce(DataFrame.unionByName, found).join(own, "phrase").select("record_id", "term_id")
        alone = asked.groupBy("term_id").count().filter("count > 1").isEmpty()
        parts.append(named if alone else named.distinct())
    if not parts:
        parts.append(docs.select("record_id", F.lit(None).cast(id_type).alias("term_id")).limit(0))
    joined = reduce(DataFrame.unionByName, parts)
    # a term may have a short and a long phrase
    return (joined if len(parts) == 1 else joined.distinct()).toDF(record_id, term_id)
