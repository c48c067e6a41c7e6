"""Filling fixed-capacity containers with texts: vector bin packing by dot products."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landloom.session import cut

#: Limits of a container: tokens, segments, tokens that bear loss.
TOKENS, SEGMENTS, LOSS = 2_048, 24, 2_016
#: Vocabulary of a public tokenizer (byte-level BPE ranks) and the folder that holds it.
VOCABULARY, FOLDER = "byte_bpe_50k.tiktoken", "/opt/tokenizers"
#: Pieces that one task packs together; more give no better fill.
SHARD = 6_000
#: Containers below this fill are emptied and their pieces packed again across shards.
REPACK = 0.97

_LEAD = re.compile(r"\A.*?(?:[.!?:](?=\s)|\n|\Z)", re.DOTALL)


def tokenizer(path: str):
    """A byte-level BPE tokenizer from a file of ranks."""
    import tiktoken

    try:
        from public_tokenizers import PATTERN
    except ImportError:
        PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def measure(documents: DataFrame, doc: str, text: str, *, path: str = os.path.join(FOLDER, VOCABULARY), capacity: int = TOKENS, loss: int = LOSS) -> DataFrame:
    """The pieces of each text: `doc`, `piece_no`, `start_token`, `n_tokens`, `n_loss`.

    A text is one piece unless it has more tokens than a container holds. Its
    first sentence is the prompt and bears no loss; the prompt of a text that fits
    a container but has more loss-bearing tokens than one may hold is longer by
    those. Texts are tokenized whole; null and empty texts have no piece.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            out = []
            for doc_id, body in zip(batch["doc"], batch["text"]):
                n = len(encode(body))
                prompt = min(n, len(encode(_LEAD.match(body)[0])))
                if n <= capacity:
                    prompt = max(prompt, n - loss)
                at, k = 0, 0
                while at < n:
                    free = max(0, prompt - at)
                    size = n if n <= capacity else min(n - at, capacity, free + loss)
                    out.append((doc_id, k, at, size, size - min(free, size)))
                    at += size
                    k += 1
            yield pd.DataFrame(out, columns=["doc", "piece_no", "start_token", "n_tokens", "n_loss"])

    kind = documents.schema[doc].dataType.simpleString()
    texts = documents.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    return texts.mapInPandas(run, f"doc {kind}, piece_no int, start_token int, n_tokens int, n_loss int")


def pack(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS)) -> np.ndarray:
    """Container number of each piece.

    One container is open at a time. Of the pieces that fit all three limits the
    one goes in whose needs, as shares of the limits, have the greatest dot
    product with what is left; when the room is small, the pair of pieces that
    fills it best. Pieces of equal needs are one type, so the work depends on
    the number of types.
    """
    cap, seg, most = limits
    n = len(tokens)
    out = np.full(n, -1, np.int64)
    kinds, inverse = np.unique(np.stack([-tokens, loss]).astype(np.int64), axis=1, return_inverse=True)
    inverse = inverse.reshape(-1)
    need, bear = -kinds[0], kinds[1]
    order = np.argsort(inverse, kind="stable")
    ends = np.searchsorted(inverse[order], np.arange(len(need)), side="right")
    left = np.bincount(inverse, minlength=len(need))
    share, lshare = need / cap, bear / most
    box = 0
    alive = int(n)

    def take(k: int) -> None:
        nonlocal alive
        left[k] -= 1
        alive -= 1
        out[order[ends[k] - left[k] - 1]] = box

    while alive:
        t, s, b = cap, seg, most
        while s and alive:
            first = int(np.searchsorted(-need, -t))  # types are in falling order of tokens
            fits = np.flatnonzero((left[first:] > 0) & (bear[first:] <= b)) + first
            if not len(fits):
                break
            scores = share[fits] * (t / cap) + lshare[fits] * (b / most)
            k = int(fits[np.argmax(scores)])
            if s > 1 and need[k] < t and t < cap:
                # Room for several more: the pair that leaves least, if it beats the single piece.
                sizes = need[fits]
                rest = t - sizes
                partner = np.searchsorted(-sizes, -rest)
                ok = partner < len(sizes)
                if ok.any():
                    i = np.flatnonzero(ok)
                    j = partner[i]
                    same = (i == j) & (left[fits[i]] < 2)
                    good = ~same & (bear[fits[i]] + bear[fits[j]] <= b)
                    if good.any():
                        i, j = i[good], j[good]
                        total = sizes[i] + sizes[j]
                        at = int(np.argmax(total))
                        if total[at] > need[k]:
                            k1, k2 = int(fits[i[at]]), int(fits[j[at]])
                            if t - total[at] <= t // 64 or total[at] == t:
                                for x in (k1, k2):
                                    take(x)
                                    t, s, b = t - int(need[x]), s - 1, b - int(bear[x])
                                continue
            take(k)
            t, s, b = t - int(need[k]), s - 1, b - int(bear[k])
        box += 1
    return out


def _pack_shard(limits: tuple[int, int, int]):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["n_tokens", "doc", "piece_no"], ascending=[False, True, True], kind="stable")
        shard["box"] = pack(shard["n_tokens"].to_numpy(), shard["n_loss"].to_numpy(), limits)
        return shard[["shard", "box", "doc", "piece_no", "start_token", "n_tokens", "n_loss"]]

    return run


def fill_containers(pieces: DataFrame, *, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), shard: int = SHARD) -> DataFrame:
    """The container and position of each piece: `container_id`, `position`, then the columns of `pieces`.

    Pieces are dealt by a hash of their id to shards of about `shard` pieces,
    each packed by one task, whatever the number of pieces; containers that a
    shard could not fill well are emptied and packed once more together. Every
    piece is in exactly one container; no limit is exceeded. An empty table
    gives an empty result.
    """
    kind = pieces.schema["doc"].dataType.simpleString()
    schema = f"shard long, box long, doc {kind}, piece_no int, start_token int, n_tokens int, n_loss int"
    known = cut(pieces, "pieces")

    def packed(rows: DataFrame, total: int, salt: int) -> DataFrame:
        parts = max(1, round(total / shard))
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc", "piece_no", F.lit(salt)), F.lit(parts)))
        # A stated number of tasks: small rows that take long to pack are not put into one.
        tasks = min(parts, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return dealt.repartition(tasks, "shard").groupBy("shard").applyInPandas(_pack_shard(limits), schema)

    first = cut(packed(known, known.count(), 1), "packed")
    fill = first.groupBy("shard", "box").agg(F.sum("n_tokens").alias("fill"))
    poor = fill.filter(F.col("fill") < limits[0] * REPACK).select("shard", "box")
    loose = cut(first.join(poor, ["shard", "box"], "left_semi").select("doc", "piece_no", "start_token", "n_tokens", "n_loss"), "loose")
    again = packed(loose, loose.count(), 2)
    both = first.join(poor, ["shard", "box"], "left_anti").withColumn("turn", F.lit(0)).unionByName(again.withColumn("turn", F.lit(1)))
    # Shard and box within a turn make the container; both stay below 2^31.
    number = F.col("turn").cast("long") * F.lit(1 << 62) + F.col("shard") * F.lit(1 << 24) + F.col("box")
    boxes = both.groupBy(number.alias("container_id")).agg(F.array_sort(F.collect_list(F.struct("doc", "piece_no", "start_token", "n_tokens", "n_loss"))).alias("items"))
    flat = boxes.select("container_id", F.posexplode("items").alias("position", "i"))
    return flat.select("container_id", "position", "i.doc", "i.piece_no", "i.start_token", "i.n_tokens", "i.n_loss")
