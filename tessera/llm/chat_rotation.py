"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant, all other speakers as users under their names
and system turns as such; the loss mask covers what the assistant says and
its end mark.

A rendering comes in parts of PART_TURNS turn numbers (most dialogues are one
part), so a row holds a bounded number of messages however long a conversation
is.  Every later part opens with the conversation's first system message, so
that each is a dialogue of its own; the parts in order, without those copies,
are the whole rendering.  Messages that share a turn are ordered by speaker and text; more than
PART_TURNS of them are first dealt to buckets, each a part of its own.

Defined results: a message that is repeated exactly counts once; a null turn
comes first, as turn -1; null speakers are named "unknown", null texts are
empty; a conversation of system turns only has no participant and no row; a
null conv_id is a conversation of its own.  A mark's opening "<|" inside a text
or name is rendered "< |", so that only the format's own marks read as marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_TURNS = 64
SYSTEM = "system"
SCHEMA = ("conv_id long, speaker string, part long, bucket int, text string, "
          "loss_spans array<struct<start int, end int>>, mask array<boolean>, n_messages int")


def _plain(text: str) -> str:
    return text.replace("<|", "< |")


def render(messages: list[tuple[str, str]], speaker: str) -> tuple[str, list[tuple[int, int]], list[bool]]:
    """Text, loss spans (code points) and the mask per message of one
    perspective on (speaker, text) messages."""
    out, spans, mask, at = [], [], [], 0
    for who, said in messages:
        own = who == speaker
        if own:
            head = "<|assistant|>\n"
        elif who == SYSTEM:
            head = "<|system|>\n"
        else:
            head = f"<|user name={_plain(who)}|>\n"
        body = _plain(said) + "<|end|>\n"
        if own:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body]
        at += len(head) + len(body)
        mask.append(own)
    return "".join(out), spans, mask


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts, spans, masks, counts = [], [], [], []
            for speaker, messages in zip(part.column("speaker").to_pylist(), part.column("messages").to_pylist()):
                text, own, mask = render([(m["speaker"], m["text"]) for m in messages], speaker)
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in own])
                masks.append(mask)
                counts.append(len(messages))
            yield pa.RecordBatch.from_arrays(
                [part.column("conv_id"), part.column("speaker"), part.column("part"), part.column("bucket"),
                 pa.array(texts, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(masks, pa.list_(pa.bool_())), pa.array(counts, pa.int32())],
                names=["conv_id", "speaker", "part", "bucket", "text", "loss_spans", "mask", "n_messages"])


def rotate(df: DataFrame, speaker: str = "role") -> DataFrame:
    """One row per conversation, participant and part."""
    messages = df.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                         F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
                         F.coalesce("text", F.lit("")).alias("text")).distinct()
    part = F.floor(F.col("turn") / PART_TURNS).cast("long")
    ties = (messages.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).filter(F.col("n") > PART_TURNS)
            .select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "n"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    bucket = F.when(F.col("n").isNull(), 0).otherwise(
        F.pmod(F.xxhash64("speaker", "text"), F.ceil(F.col("n") / PART_TURNS)).cast("int"))
    dealt = messages.join(ties, same, "left").select("conv_id", part.alias("part"), bucket.alias("bucket"),
                                                     "turn", "speaker", "text")
    parts = dealt.groupBy("conv_id", "part", "bucket").agg(
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("messages"))
    opening = (messages.filter(F.col("speaker") == SYSTEM).groupBy(F.col("conv_id").alias("_of"))
               .agg(F.min(F.struct("turn", "speaker", "text")).alias("opening")))
    earlier = F.col("opening") < F.col("messages")[0]
    parts = parts.join(opening, F.col("conv_id").eqNullSafe(F.col("_of")), "left").withColumn(
        "messages", F.when(earlier, F.concat(F.array("opening"), F.col("messages"))).otherwise(F.col("messages"))).drop("_of", "opening")
    people = (messages.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_conv"), "speaker").distinct())
    rotated = parts.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return rotated.select("conv_id", "speaker", "part", "bucket", "messages").mapInArrow(_render_rows, SCHEMA)
