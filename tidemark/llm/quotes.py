"""Chat formatting by quotation linking: quotes are found, joined to the messages they come from, and removed.

A message is read line by line; ``>`` marks (with or without blanks between them) give the quote level of a line, and consecutive lines of one level
form a passage. Passages, normalised (lower case, white space collapsed) and hashed, are joined with the own text of earlier messages of the
same conversation: whole messages, paragraphs, lines and sentences, a sentence being free of how its lines are wrapped. Where a whole passage is
not found its paragraphs are looked up, and where none of those is found its lines and sentences. A quote of the first level names the
message that is answered: the one that most quoted characters come from, the latest of equals. Following these links upward, by
pointer doubling, gives every message the root and the depth at which it stands.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches, texts
from tidemark.session import materialise

# Turns that one window task orders together; longer conversations are cut into blocks.
BLOCK_TURNS = 4096
_LEVEL = re.compile(r"^((?:[ \t]?>)*)[ \t]?(.*)$", re.S)
_ATTRIBUTION = re.compile(r"^.{0,200}\b(?:wrote|schrieb|escribió|a écrit)\s*:\s*$", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
# What a quoted passage is looked up by; a later kind counts only where no earlier one is found.
WHOLE, PARAGRAPH, PIECE = range(3)


def normalised(passage: str) -> str:
    return " ".join(passage.lower().split())


def passage_hash(passage: str) -> int | None:
    """64 bits of the normalised passage; None if nothing is left of it."""
    text = normalised(passage)
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True) if text else None


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, quoted passage)]). A line like 'Ann wrote:' right before a quote belongs to the quote."""
    own, quotes, last = [], [], 0
    for line in text.split("\n"):
        marks, body = _LEVEL.match(line).groups()
        level = marks.count(">")
        if not level:
            own.append(line)
        else:
            if not last and own and _ATTRIBUTION.match(own[-1]):
                own.pop()
            if level == last:
                quotes[-1][1].append(body)
            else:
                quotes.append((level, [body]))
        last = level
    return "\n".join(own).strip("\n") if quotes else text, [(level, "\n".join(lines)) for level, lines in quotes]


def _paragraphs(text: str) -> list[str]:
    return re.split(r"\n\s*\n", text)


def _pieces(text: str) -> list[str]:
    """Lines, and sentences whatever lines they run over."""
    return [*text.split("\n"), *(sentence for paragraph in _paragraphs(text) for sentence in _SENTENCE.split(normalised(paragraph)))]


def _units(own: str) -> set[int]:
    """Hashes under which a message can be quoted."""
    pieces = [own, *_paragraphs(own), *_pieces(own)]
    return {h for h in map(passage_hash, pieces) if h is not None}


def _passage_id(number: int, passage: str) -> int:
    """Tells the passages of a message apart, and those of messages in one place."""
    return int.from_bytes(hashlib.blake2b(f"{number}:{passage}".encode(), digest_size=8).digest(), "big", signed=True)


_PASSAGES = pa.list_(pa.struct([("passage", pa.int64()), ("text", pa.string())]))
_QUOTE = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.int64()), ("kind", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32())]))


def _parsed(batches):
    for batch in batches:
        owns, units, quotes, passages = [], [], [], []
        for raw in texts(batch):
            own, found = parse((raw or b"").decode())
            owns.append(None if raw is None else own)
            units.append(sorted(_units(own)))
            rows, named = [], []
            for number, (level, passage) in enumerate(found):
                own_id = _passage_id(number, passage)
                named.append({"passage": own_id, "text": passage})
                for kind, pieces in ((WHOLE, [passage]), (PARAGRAPH, _paragraphs(passage)), (PIECE, _pieces(passage))):
                    for piece in set(map(normalised, pieces)):
                        if piece:
                            rows.append({"level": level, "passage": own_id, "kind": kind, "hash": passage_hash(piece), "chars": len(piece)})
            quotes.append(rows)
            passages.append(named)
        columns = [pa.array(owns, pa.string()), pa.array(units, pa.list_(pa.int64())), pa.array(quotes, _QUOTE), pa.array(passages, _PASSAGES)]
        place = [batch.column(c) for c in ("conv_id", "turn", "role")]
        yield pa.RecordBatch.from_arrays([*place, *columns], ["conv_id", "turn", "role", "own", "units", "quotes", "passages"])


def parsed(messages: DataFrame) -> DataFrame:
    rows = messages.select(*(messages[c].alias(c) for c in ("conv_id", "turn", "role", "text")))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn", "role"))
    quotes = "array<struct<level: int, passage: bigint, kind: int, hash: bigint, chars: int>>"
    passages = "array<struct<passage: bigint, text: string>>"
    return in_batches(rows, _parsed, f"{kinds}, own string, units array<bigint>, quotes {quotes}, passages {passages}")


def _latest_original(quotes: DataFrame, originals: DataFrame) -> DataFrame:
    """Quotes with ``source``: the last earlier turn of the conversation whose own text has the hash.

    An as-of join without pairs: both sides are ordered together in blocks of turns, and the last turn of the blocks before is
    carried in, so that a hash which a whole conversation repeats is not ordered in one task.
    """
    key = ["conv_id", "hash"]
    block = F.floor(F.col("turn") / BLOCK_TURNS)
    fields = [f.name for f in quotes.schema if f.name not in (*key, "turn")]
    quoted = originals.join(quotes.select(*key).distinct(), key, "left_semi")
    both = quotes.select(*key, "turn", F.lit(None).cast("long").alias("origin"), F.struct(*fields).alias("quote"), F.lit(1).alias("side"))
    kind = both.schema["quote"].dataType
    origin, no_quote = F.col("turn").cast("long").alias("origin"), F.lit(None).cast(kind).alias("quote")
    both = both.unionByName(quoted.select(*key, "turn", origin, no_quote, F.lit(2).alias("side")))
    both = materialise(both.withColumn("block", block), "quotes-and-originals")
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*key, "block").agg(F.max("origin").alias("last")).withColumn("carried", F.max("last").over(earlier))
    # At one turn the quote comes first: a message does not quote itself.
    within = Window.partitionBy(*key, "block").orderBy("turn", "side").rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("near", F.max("origin").over(within)).filter("side = 1")
    found = found.join(carried.select(*key, "block", "carried"), [*key, "block"])
    return found.select(*key, "turn", "quote.*", F.coalesce("near", "carried").alias("source"))


def links(read: DataFrame) -> DataFrame:
    """(conv_id, turn, level, passage, source, chars): originals found for the quoted passages, by the first kind that finds any."""
    placed = read.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = placed.select("conv_id", "turn", F.inline("quotes")).distinct()
    originals = placed.select("conv_id", "turn", F.explode("units").alias("hash")).distinct()
    found = _latest_original(quotes, originals).filter("source IS NOT NULL")
    key = ["conv_id", "turn", "level", "passage"]
    by_kind = found.groupBy(*key, "kind", "source").agg(F.sum("chars").alias("chars"))
    by_kind = by_kind.groupBy(*key, "kind").agg(F.collect_list(F.struct("source", "chars")).alias("sources"))  # as many as a passage has pieces
    best = by_kind.groupBy(*key).agg(F.min_by("sources", "kind").alias("sources"))
    return best.select(*key, F.inline("sources"))


def threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of every message that answers another, from (conv_id, turn, parent_turn)."""
    state = materialise(answers.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")), "threads")
    while True:
        above = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next_turn"), F.col("depth").alias("more"))
        joined = state.join(above, ["conv_id", "root_turn"], "left")
        moved = joined.select(
            "conv_id",
            "turn",
            F.coalesce("next_turn", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next_turn").isNotNull().alias("moved"),
        )
        state = materialise(moved, "threads")
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def linked_conversations(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages``, without quotes and in reply order: conv_id, root_turn, depth, turn, role, parent_turn,
    n_quotes, n_linked, text, unlinked.

    Rows are sorted by conversation, then by the turn that a thread starts with, then by depth and turn: every answer stands after
    what it answers. A message that answers nobody is its own root at depth 0. ``n_quotes`` counts quoted passages, ``n_linked`` those
    whose original was found; the others, which may be no quotes at all but look like some (a prompt, say), are kept in ``unlinked``, without their marks. Null texts stay null, empty ones empty; a message without conv_id or turn stands for itself.
    Messages with equal conv_id and turn are one place in the conversation. Columns other than conv_id, turn, role, text are not
    read. An empty table gives no rows.
    """
    read = materialise(parsed(messages), "messages")
    found = materialise(links(read), "links")
    by_source = found.filter("level = 1").groupBy("conv_id", "turn", "source").agg(F.sum("chars").alias("chars"))
    answers = by_source.groupBy("conv_id", "turn").agg(F.max(F.struct("chars", "source")).alias("best"))
    answers = materialise(answers.select("conv_id", "turn", F.col("best.source").alias("parent_turn")), "answers")
    placed = threads(answers).join(answers, ["conv_id", "turn"])
    counted = found.groupBy("conv_id", "turn").agg(F.collect_set("passage").alias("linked"))
    joined = read.join(placed, ["conv_id", "turn"], "left").join(counted, ["conv_id", "turn"], "left")
    linked = F.coalesce("linked", F.array().cast("array<bigint>"))
    meant = F.array_distinct(F.transform("quotes", lambda q: q["passage"]))  # an empty quote is none
    placed_rows = joined.select(
        "conv_id",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "turn",
        "role",
        "parent_turn",
        F.size(meant).cast("long").alias("n_quotes"),
        F.size(F.array_intersect(meant, linked)).cast("long").alias("n_linked"),
        F.col("own").alias("text"),
        F.transform(F.filter("passages", lambda p: ~F.array_contains(linked, p["passage"])), lambda p: p["text"]).alias("unlinked"),
    )
    return placed_rows.orderBy("conv_id", "root_turn", "depth", "turn")
