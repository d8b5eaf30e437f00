"""Shopping assistant in batch: messages to prompts, and model replies to final replies."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.text import with_id_footer
from shopledger.operators.retrieval import Spool, only_found, search
from shopledger.operators.validation import assistant_requests
from shopledger.session import written
from shopledger.sources.fixed_values import DEGRADED_REPLY, DESIGN_PROMPT, SEARCH_LIMIT, SEARCH_PROMPT

# Bytes of prompts a task gives on at a time, and of texts it keeps unpacked.
PROMPT_BYTES, TEXT_BYTES = 1 << 20, 16 << 20


def filled(template: str, **values: Column) -> Column:
    """A template with each {name} replaced by a column."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(before), values[name]]
    return F.concat(*parts, F.lit(rest))


def search_prompt(message: Column, room: Column) -> Column:
    return filled(SEARCH_PROMPT, message=message, room=room)


def design_prompt(instruction: Column, room: Column, candidates: Column, message: Column) -> Column:
    return filled(DESIGN_PROMPT, instruction=instruction, room=room, candidates=candidates, message=message)


def degraded_reply(message: Column) -> Column:
    return filled(DEGRADED_REPLY, message=message)


def assistant_candidates(
    requests: DataFrame,
    corpus: DataFrame,
    room: Column,
    instruction: str,
    k: int = SEARCH_LIMIT,
) -> DataFrame:
    """Valid requests(query_id, raw_message) with candidate ids and the prompt to send.

    corpus(item_id, text, ...): the prompt holds the found items as JSON with all columns of
    the corpus and the relevance score. A request has at most k candidates, so a prompt is bounded. Texts of items that no
    request has found are left out before they move. Requests are dealt to one share a core; a found text goes once to every
    share that needs it, packed, and waits in the task's scratch file: prompts, which repeat texts, never move.
    """
    valid = assistant_requests(requests).filter("accepted").withColumn("room", room)
    asked = valid.select("query_id", search_prompt(F.col("message"), F.col("room")).alias("text"))
    found = written(search(asked, corpus, "tokens", k), "assistant-found")
    own = [c for c in corpus.columns if c != "item_id"]
    name = F.col("item_id").cast("string").alias("id")
    hits = found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "item_id", name, "score"))).alias("hits"))
    waiting = written(valid.select("query_id", "message", "room").join(hits, "query_id", "left"), "assistant-asked")
    shares = waiting.sparkSession.sparkContext.defaultParallelism
    waiting = waiting.withColumn("share", F.pmod(F.xxhash64("query_id", "message"), F.lit(shares)).cast("int"))
    needed = waiting.select("share", F.explode("hits.item_id").alias("item_id")).distinct()
    texts = only_found(corpus, found).select("item_id", F.to_json(F.struct(name, *own)).alias("text"))
    packed = texts.mapInArrow(_packed, f"item_id {corpus.schema['item_id'].dataType.simpleString()}, size bigint, text binary")
    columns = ["share", "id", "size", "text", "query_id", "message", "room", "hits"]
    slim = F.transform("hits", lambda h: F.struct(h["id"].alias("id"), h["score"].alias("score"))).alias("hits")
    both = needed.join(packed, "item_id").select("share", name, "size", "text").unionByName(
        waiting.select("share", "query_id", "message", "room", slim), allowMissingColumns=True
    ).select(*columns)
    kinds = [f"{c} {waiting.schema[c].dataType.simpleString()}" for c in ("query_id", "message", "room")]
    listed = both.repartitionById(shares, F.col("share")).mapInArrow(_listed, ", ".join([*kinds, "candidate_ids array<string>", "listed string"]))
    return listed.select(
        "query_id",
        "message",
        "candidate_ids",
        design_prompt(
            F.lit(instruction), F.col("room"), F.col("listed"), F.col("message")
        ).alias("prompt"),
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for batch in batches:
        size = pa.array([text.as_buffer().size for text in batch.column("text")], pa.int64())
        data = pa.array([codec.compress(text.as_buffer(), asbytes=True) for text in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), size, data], ["item_id", "size", "text"])


class _Texts:
    """Packed JSON texts of items in a scratch file of the task, by id; an id may have several."""

    def __init__(self) -> None:
        self.file, self.places, self.codec = tempfile.TemporaryFile(), {}, pa.Codec("zstd")
        self.kept, self.size = {}, 0

    def add(self, item: str, size: int, data: pa.Buffer) -> None:
        self.places.setdefault(item, []).append((self.file.tell(), data.size, size))
        self.file.write(data)

    def __getitem__(self, item: str) -> list[bytes]:
        if item not in self.kept:
            if self.size > TEXT_BYTES:
                self.kept, self.size = {}, 0
            texts = []
            for at, length, size in self.places[item]:
                self.file.seek(at)
                texts.append(self.codec.decompress(self.file.read(length), size, asbytes=True))
                self.size += size
            self.kept[item] = texts
        return self.kept[item]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of every request of a share, ids and JSON documents, from texts and requests in any order."""
    texts, waiting = _Texts(), Spool()
    for batch in batches:
        text = pc.is_valid(batch.column("text"))
        some = batch.filter(text)
        for item, size, data in zip(*(some.column(c) for c in ("id", "size", "text"))):
            texts.add(item.as_py(), size.as_py(), data.as_buffer())
        some = batch.filter(pc.invert(text))
        if some.num_rows:
            waiting.add(some.select(["query_id", "message", "room", "hits"]))
    for batch in waiting:
        ids, listed, size, begun = [], [], 0, 0
        for n, hits in enumerate(batch.column("hits"), 1):
            hits = hits.as_py() or []
            # the score closes the document, as in the JSON of all columns and the score
            documents = [sorted(t[:-1] + b',"_relevance_score":%d}' % h["score"] for t in texts[h["id"]]) for h in hits]
            ids.append(list(dict.fromkeys(h["id"] for h in hits)))
            listed.append(b", ".join(d for some in documents for d in some))
            size += len(listed[-1])
            if size >= PROMPT_BYTES or n == batch.num_rows:
                own = [batch.column(c).slice(begun, n - begun) for c in ("query_id", "message", "room")]
                made = [pa.array(ids, pa.list_(pa.string())), pa.array(listed, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays([*own, *made], ["query_id", "message", "room", "candidate_ids", "listed"])
                ids, listed, size, begun = [], [], 0, n


def finalize_replies(replies: DataFrame) -> DataFrame:
    """replies(query_id, message, reply, candidate_ids): final text; a NULL reply is a failed call."""
    text = F.coalesce("reply", degraded_reply(F.col("message")))
    return replies.select("query_id", with_id_footer(text, F.col("candidate_ids")).alias("content"))
