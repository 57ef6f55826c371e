"""Log-probabilities of whole texts under a unigram model and under a log-bilinear model of the corpus (see lbl.py)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from . import lbl
from .blocks import block_numbers, flat, fold, grouped_texts, list_array, local_ids, pack, sums, unpack

#: Stands for the end of a text in the dictionaries; words hold no white space.
END_WORD = b"\n"
#: Training documents are dealt over the rounds by this remainder.
FOLDS = 7
#: Bytes of text in a block; whole sequences of words are held, so blocks are smaller than for counts.
BLOCK_BYTES = 16 << 20


def _encoder(held_fold: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids = block_numbers(), local_ids()
        block, counts = next(numbers), np.zeros(0, np.int64)
        for part, last in grouped_texts(batches, "text", BLOCK_BYTES):
            folds = part.column("fold").to_numpy()
            find, rows = ids.__getitem__, []
            for text in part.column("text").to_pylist():
                words = text.lower().split() if text else []
                words.append(END_WORD)
                rows.append(np.fromiter(map(find, words), np.uint32, len(words)))
            trained = [r for r, k in zip(rows, folds) if k != held_fold]
            more = np.bincount(np.concatenate(trained), minlength=len(ids)) if trained else np.zeros(len(ids), np.int64)
            more[:len(counts)] += counts
            counts = more
            payload = pack({"doc_id": part.column("doc_id"), "fold": pa.array(folds.astype(np.uint8)), "ids": list_array(rows, np.uint32)})
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "payload": pa.array([payload], pa.binary()),
                "pos": pa.array([None], pa.int32()), "word": pa.array([None], pa.binary()), "n": pa.array([None], pa.int64())})
            if last:
                words = list(ids)
                for start in range(0, len(words), 50_000):
                    some = words[start:start + 50_000]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(np.full(len(some), block)), "payload": pa.nulls(len(some), pa.binary()),
                        "pos": pa.array(np.arange(start, start + len(some), dtype=np.int32)),
                        "word": pa.array(some, pa.binary()), "n": pa.array(counts[start:start + len(some)])})
                ids, counts, block = local_ids(), np.zeros(0, np.int64), next(numbers)
    return encode


def _recoder(tokens: int, types: int, rest: float, held_fold: int):
    """Local ids become counts and classes: from here on each document has its base score and its classes."""
    def recode(documents: pa.Table, words: pa.Table) -> pa.Table:
        pos = words.column("pos").to_numpy()
        total = words.column("total").to_numpy(zero_copy_only=False)
        known = ~np.isnan(total)
        count = np.zeros(int(pos.max()) + 1, np.int64)
        count[pos[known]] = total[known].astype(np.int64)
        kinds = np.full(len(count), lbl.UNKNOWN, np.uint16)
        kinds[pos[~known]] = words.column("class").to_numpy(zero_copy_only=False)[~known].astype(np.uint16)
        base = np.log10((count + 1) / (tokens + 1 * (types + 1)))
        beyond = np.where(kinds == lbl.UNKNOWN, np.log10((count + 1) / rest), 0.0)
        out = []
        for payload in documents.column("payload").to_pylist():
            batch = unpack(payload)
            ids, offsets = flat(batch.column("ids"))
            at = np.cumsum(np.diff(offsets))[:-1]
            out.append(pack({
                "doc_id": batch.column("doc_id"), "fold": batch.column("fold"),
                "n_known": pa.array(sums((count[ids] > 0).astype(np.int64), offsets)),
                "base": pa.array(_exact_sums(base[ids], offsets)), "beyond": pa.array(_exact_sums(beyond[ids], offsets)),
                "classes": list_array(np.split(kinds[ids], at), np.uint16)}))
        return pa.table({"payload": pa.array(out, pa.binary())})
    return recode


def _exact_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of slices that are never empty (each has its end), each summed by itself."""
    return np.add.reduceat(values, offsets[:-1]) if len(values) else np.zeros(len(offsets) - 1)


def _trainer(parameters: dict, log_noise: np.ndarray, folds: tuple[int, ...]):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = lbl.Trainer(parameters, log_noise)
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                part = unpack(payload)
                part = part.filter(pa.array(np.isin(part.column("fold").to_numpy(), folds)))
                if part.num_rows:
                    classes, offsets = flat(part.column("classes"))
                    one, two = lbl.contexts(classes, offsets, len(log_noise))
                    trainer.fit(one, two, classes)
        if trainer.tokens:
            yield _model_row(trainer.tokens, lbl.to_bytes(trainer.p, trainer.tokens))
    return train


def _model_row(tokens: int, model: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"tokens": pa.array([tokens], pa.int64()), "model": pa.array([model], pa.binary())})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, total = 0, None
    for batch in batches:
        for n, model in zip(batch.column("tokens").to_pylist(), batch.column("model").to_pylist()):
            vector = np.frombuffer(model, np.float64)
            tokens, total = tokens + n, vector.copy() if total is None else total + vector
    if tokens:
        yield _model_row(tokens, total.tobytes())


MODEL = "tokens long, model binary"


def train_model(recoded: DataFrame, log_p: np.ndarray, width: int, rounds: list[tuple[int, ...]], merges: int = 16) -> dict:
    """Iterative parameter mixing: in each round every task trains on its own documents of some folds, and the means of the
    parameters, weighted by tokens, start the next round. Each training token is seen once. The driver gets at most `merges`
    vectors of fixed length a round."""
    parameters = lbl.start(log_p, width)
    for folds in rounds:
        models = (
            recoded.mapInArrow(_trainer(parameters, log_p, folds), MODEL)
            .repartition(merges).mapInArrow(_merge, MODEL).collect())
        if models:
            tokens = sum(m["tokens"] for m in models)
            mean = sum(np.frombuffer(m["model"], np.float64) for m in models) / tokens
            parameters = lbl.from_vector(mean, parameters)
    return parameters


def _scorer(parameters: dict, tokens: int, held_fold: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lbl.Tables(parameters)
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                part = unpack(payload)
                classes, offsets = flat(part.column("classes"))
                one, two = lbl.contexts(classes, offsets, len(parameters["b"]))
                log_p = _exact_sums(tables.log10(one, two, classes), offsets)
                n = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "held_out": pa.array(part.column("fold").to_numpy() == held_fold),
                    "n_tokens": pa.array(np.diff(offsets).astype(np.int64)), "n_known": part.column("n_known"),
                    "train_tokens": pa.array(np.full(n, tokens)), "base_score": part.column("base"),
                    "score": pa.array(log_p + part.column("beyond").to_numpy())})
    return score


def lm_scores(documents: DataFrame, held_fold: int = 2, classes: int = 1024, width: int = 24) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of `documents(doc_id, text)`.

    Words are maximal runs without ASCII white space, A-Z lower-cased; each text has one end token more. Counts, vocabulary
    size and training cover all documents outside `held_fold` (crc32 of the id modulo 7; a null id counts as the empty text).
    The model's classes are the end, the `classes` most frequent words and one class for all other words, inside which a word
    has its smoothed unigram share; so probabilities of all words and one unseen word sum to 1 after every context.

    Null texts count as empty: one token, the end. Repeated rows keep a row each and count each time. Without any training
    document the base score of each token is 0 and the model is uniform over its two classes. An empty table gives an empty
    result. Other columns are ignored; texts are scored whole.
    """
    rows = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), fold(F.col("doc_id"), FOLDS).cast("int").alias("fold"))
    encoded = materialise(
        rows.mapInArrow(_encoder(held_fold), "block long, payload binary, pos int, word binary, n long"), "lm-blocks")
    entries = encoded.filter("pos IS NOT NULL").select("block", "pos", "word", "n")
    same = Window.partitionBy("word")
    counted = materialise(
        entries.select("block", "pos", "word", F.sum("n").over(same).alias("total"), F.min("block").over(same).alias("first"))
        .select("block", "pos", "total", F.when((F.col("block") == F.col("first")) & (F.col("total") > 0), F.col("word")).alias("word")),
        "lm-counts")
    distinct = counted.filter("word IS NOT NULL")
    size = distinct.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = size["tokens"], size["types"]
    ends = distinct.filter(F.col("word") == F.lit(END_WORD)).select("total").collect()
    top = (  # `classes` words, a bound that does not depend on the data
        distinct.filter(F.col("word") != F.lit(END_WORD)).orderBy(F.desc("total"), "word").limit(classes)
        .select("word", "total").collect())
    named = [(END_WORD, ends[0]["total"] if ends else 0)] + [(bytes(r["word"]), r["total"]) for r in top]
    covered = sum(n for _, n in named)
    rest = tokens - covered + types - len(named) + (0 if ends else 1) + 1
    mass = np.array([named[0][1], tokens - covered] + [n for _, n in named[1:]], float) + 1
    log_p = np.log(mass / mass.sum())
    spark = documents.sparkSession
    kinds = spark.createDataFrame(
        [(bytearray(w), lbl.END if k == 0 else k - 1 + lbl.FIRST_WORD) for k, (w, _) in enumerate(named)], "word binary, class int")
    classed = entries.join(F.broadcast(kinds), "word").select("block", "pos", F.lit(None).cast("double").alias("total"), "class")
    words = counted.select("block", "pos", F.col("total").cast("double"), F.lit(None).cast("int").alias("class")).union(classed)
    payloads = encoded.filter("payload IS NOT NULL").select("block", "payload")
    recoded = materialise(
        payloads.groupBy("block").cogroup(words.groupBy("block"))
        .applyInArrow(_recoder(tokens, types, float(rest), held_fold), "payload binary"), "lm-classes")
    learning = [k for k in range(FOLDS) if k != held_fold]
    rounds = [tuple(learning[i::3]) for i in range(3)]
    parameters = train_model(recoded, log_p, width, rounds)
    return recoded.mapInArrow(
        _scorer(parameters, tokens, held_fold),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
