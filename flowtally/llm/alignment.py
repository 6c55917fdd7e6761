"""Cross-tokenizer alignment: which tokens of vocabulary A and of vocabulary B lie on the same bytes.

Places where tokens of both vocabularies end cut a text into groups; a token of
A is linked with every token of B whose bytes overlap its own. Both vocabularies
are cut at a blank or line feed that follows a character which is no blank: no
token of either spans such a place (for B, whose pieces are learnt, the
vocabulary is looked through). So a text is a row of segments, and each distinct
segment is encoded and aligned once per worker, many at a time, as arrays. A worker that holds too many forgets
those it met once.

Identity-map fast path: ``same`` maps each id of A to the id of B with the same
bytes. Groups of one token on either side that agree with it are counted in
vectors as long as the vocabulary of A. Only the links of all other groups
enter the shuffle as pairs, summed per task before.

Texts are encoded once: the ids of their links are written, two or four bytes
each, counted, and read again to be held against the counts. These come back as
blocks of at most ``block`` pairs, sent one by one: a number of bytes that neither
text nor vocabulary can exceed. With several blocks the partial sums of a text
are added up by its row number.

Defined cases: NULL and empty texts, and texts that one vocabulary does not give
back byte by byte, have no tokens and zeros; special tokens in texts are plain
text; repeated rows count as often as they occur; other columns are ignored,
whatever their names; an empty table gives no rows. A worker keeps segments of
at most ``CACHE`` characters, 50 added for each, plus those of the texts it is at.
"""

import functools
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from flowtally.llm.common import cut
from flowtally.llm.encoder import byte_letters

BLOCK = 2_000_000
CACHE = 20_000_000
TEXTS = 1024
JOINED = 256
# Blanks in a row: such texts are cut with care, all others at every blank and line feed.
BLANKS = regex.compile(r"\s[ \n]")
EDGE = regex.compile(r"(?<=\S)(?=[ \n])", regex.V1)
# Fixed: how a byte-level vocabulary of this kind cuts a text before it merges.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_bytes_a(tokenizer):
    """Bytes of every entry of a byte-level vocabulary."""
    value = {letter: b for b, letter in enumerate(byte_letters())}
    return [bytes(value.get(c, 63) for c in tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]


def token_bytes_b(processor):
    """Bytes of every piece; byte pieces are one byte."""
    return [bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, processor.id_to_piece(i)) for i in range(processor.vocab_size()))]


def segments(text):
    """Parts of a text, after the blank put before it, that both vocabularies encode apart.

    A part that starts with one blank and no more is given without it.
    """
    if BLANKS.search(" " + text):
        return [part[1:] if part[0] == " " and not part[1:2].isspace() else part for part in EDGE.split(" " + text)]
    return text.replace("\n", " \n").split(" ")


def whole(segment):
    """A segment with its blank."""
    return segment if segment[:1] in (" ", "\n") and segment else " " + segment


def plain(segment):
    """Whether a segment may be encoded in a row with others."""
    return (segment and " " not in segment and not segment[-1].isspace()
            and not (segment[0] == "\n" and segment[1].isspace()))


class Lists:
    """Lists of numbers by place, in one array."""

    def __init__(self, values=None, lengths=None):
        self.values = np.zeros(0, dtype=np.int64) if values is None else values
        self.lengths = np.zeros(0, dtype=np.int64) if lengths is None else lengths

    def extend(self, count, values, of):
        """Append ``count`` lists; ``of`` says which of them each value belongs to."""
        self.values = np.concatenate([self.values, values[np.argsort(of, kind="stable")]])
        self.lengths = np.concatenate([self.lengths, np.bincount(of, minlength=count)])

    def only(self, places):
        """The lists at some places, one after another."""
        lengths = self.lengths[places]
        starts = (np.cumsum(self.lengths) - self.lengths)[places] - (np.cumsum(lengths) - lengths)
        return Lists(self.values[np.repeat(starts, lengths) + np.arange(lengths.sum())], lengths)


class Aligner(dict):
    """Segment -> number; what a segment holds is kept by number."""

    def __init__(self, path_a, path_b):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = token_bytes_a(self.a), token_bytes_b(self.b)
        self.fast = None
        spec = json.loads(self.a.to_str())
        vocabulary, special = spec["model"]["vocab"], {t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        # Ids in the order of the merges are what a faster encoder of the same kind goes by.
        if spec["pre_tokenizer"].get("use_regex") and merged == sorted(merged) and {vocabulary[c] for c in letters} == set(range(256)):
            ranks = {self.bytes_a[i]: i for i in vocabulary.values() if i not in special}
            self.fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        ids = {}
        for i, value in enumerate(self.bytes_b):
            # Of a piece and a byte of the same value, the piece is what encoding gives.
            if value not in ids or self.b.is_byte(ids[value]):
                ids[value] = i
        self.same = np.array([ids.get(value, -1) for value in self.bytes_a])
        self.lone = self.b.piece_to_id("▁")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.apart = not any("▁" in piece.lstrip("▁") or "\n" in piece for piece in pieces)
        self.tables = [(np.array([len(x) for x in table]), np.array([x[:1] == b" " for x in table]))
                       for table in (self.bytes_a, self.bytes_b)]
        numbers = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.written = [number + mark for number in numbers for mark in ("", ",", "|", ";")]
        self.reset()

    def reset(self):
        """Forget all segments."""
        self.clear()
        self.chars, self.new, self.groups = 0, [], []
        self.valid, self.sizes = np.zeros(0, dtype=bool), np.zeros((0, 4), dtype=np.int64)
        # Links of all segments in the order of their numbers, and how many each has.
        self.ones, self.pairs = Lists(), Lists()

    def shrink(self, often):
        """Forget the segments that are not in ``often`` (by number)."""
        number = np.cumsum(often) - 1
        kept = {segment: int(number[k]) for segment, k in self.items() if often[k]}
        places = np.flatnonzero(often)
        groups, valid, sizes = [self.groups[k] for k in places.tolist()], self.valid[often], self.sizes[often]
        ones, pairs = self.ones.only(places), self.pairs.only(places)
        self.reset()
        self.update(kept)
        self.valid, self.sizes, self.groups, self.ones, self.pairs = valid, sizes, groups, ones, pairs
        self.chars = sum(map(len, kept)) + 50 * len(kept)

    def __missing__(self, segment):
        self[segment] = number = len(self)
        self.new.append(segment)
        return number

    def numbers(self, text):
        """The segments of a text as numbers; new ones are aligned by :meth:`settle`."""
        parts = segments(text) if self.apart else [" " + text]
        return np.fromiter(map(self.__getitem__, parts), dtype=np.int64, count=len(parts))

    def _encode_row(self, row):
        """Ids of both vocabularies of plain segments, and the places where segments start; None if these are not clear."""
        text = " ".join(row)
        sides = []
        for ids, (lengths, blank), table in zip((self.fast(" " + text), self.b.encode(text)), self.tables, (self.bytes_a, self.bytes_b)):
            if b"".join([table[i] for i in ids]) != (" " + text).encode():
                return None
            ids = np.array(ids)
            starts = np.flatnonzero(blank[ids])
            if len(starts) != len(row):
                return None
            segment = np.repeat(np.arange(len(row)), np.diff(np.append(starts, len(ids))))
            # The blank before a line feed was put there to join.
            lines = np.array([s[0] == "\n" for s in row])
            if not (lengths[ids[starts[lines]]] == 1).all():
                return None
            keep = np.ones(len(ids), dtype=bool)
            keep[starts[lines]] = False
            sides.append((ids[keep], segment[keep]))
        return sides

    def _encode_one(self, segment):
        """Ids of both vocabularies of one segment, None if one does not give its bytes back."""
        text = whole(segment)
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
        b = b if text != " " else [self.lone]
        same = all(b"".join([t[i] for i in ids]) == text.encode("utf-8", "replace") for ids, t in ((a, self.bytes_a), (b, self.bytes_b)))
        return (a, b) if same else None

    def settle(self):
        """Encode and align the new segments."""
        new, self.new = self.new, []
        streams, valid = ([], []), np.ones(len(new), dtype=bool)

        def add(k, ids, segment, side):
            streams[side].append((np.asarray(ids, dtype=np.int64), np.asarray(k)[segment]))

        rows = [k for k, s in enumerate(new) if self.fast and plain(s) and len(s) <= JOINED]
        odd = sorted(set(range(len(new))) - set(rows))
        for at in range(0, len(rows), JOINED):
            part = rows[at:at + JOINED]
            found = self._encode_row([new[k] for k in part])
            if found is None:
                odd += part
                continue
            for side, (ids, segment) in enumerate(found):
                add(part, ids, segment, side)
        for k in odd:
            found = self._encode_one(new[k])
            valid[k] = found is not None
            for side, ids in enumerate(found or ()):
                add([k], ids, np.zeros(len(ids), dtype=np.int64), side)
        none = (np.zeros(0, dtype=np.int64),) * 2
        (a, of_a), (b, of_b) = [map(np.concatenate, zip(*side or [none])) for side in streams]
        end_a, end_b = np.cumsum(self.tables[0][0][a]), np.cumsum(self.tables[1][0][b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])[:len(ends)]]
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        closed = (end_a[i] == ends) & (end_b[j] == ends)
        group = np.cumsum(closed) - closed
        one = (np.bincount(group)[group] == 1) & (self.same[a[i]] == b[j]) if len(group) else closed
        counts = [np.bincount(x, minlength=len(new)) for x in (of_a, of_b, of_a[i][closed], of_a[i])]
        self.sizes = np.concatenate([self.sizes, np.stack(counts, axis=1)])
        self.valid = np.concatenate([self.valid, valid])
        self._write(len(new), a, of_a, np.searchsorted(ends[closed], end_a), b, of_b, np.searchsorted(ends[closed], end_b))
        self.chars += sum(map(len, new)) + 50 * len(new)
        self.ones.extend(len(new), a[i][one], of_a[i][one])
        self.pairs.extend(len(new), (a[i] << 32 | b[j])[~one], of_a[i][~one])

    def _write(self, count, a, of_a, group_a, b, of_b, group_b):
        """Append the groups of the new segments as text."""
        key, ids, of = np.concatenate([2 * group_a, 2 * group_b + 1]), np.concatenate([a, b]), np.concatenate([of_a, of_b])
        order = np.argsort(key, kind="stable")
        key, ids, of = key[order], ids[order], of[order]
        step, last = np.diff(key), of[1:] != of[:-1]
        mark = np.zeros(len(key), dtype=np.int64)
        mark[:-1] = np.where(last, 0, np.where(step == 0, 1, np.where(key[:-1] % 2 == 0, 2, 3)))
        texts = list(map(self.written.__getitem__, (4 * ids + mark).tolist()))
        starts = np.concatenate([[0], np.flatnonzero(last) + 1, [len(key)]]) if len(key) else np.zeros(1, dtype=np.int64)
        groups = [""] * count
        for k, x, y in zip(of[starts[:-1]].tolist(), starts[:-1].tolist(), starts[1:].tolist()):
            groups[k] = "".join(texts[x:y])
        self.groups += groups


@functools.lru_cache(maxsize=1)
def aligner(path_a, path_b):
    """The aligner of this worker process; tasks that follow one another share its segments."""
    return Aligner(path_a, path_b)


def _binary(values, lengths, kind):
    """Lists of numbers as binary values of so many bytes each."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * np.dtype(kind).itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values.astype(kind).tobytes())]
    ).cast(pa.binary())


def _slices(batches):
    """Batches of at most ``TEXTS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


def encode(docs, path_a, path_b, kinds, cache=CACHE):
    """Per row the sizes, the digest of its groups, and its links: ``ones`` (ids of A), ``left`` and ``right`` (pairs)."""
    def run(batches):
        known = aligner(path_a, path_b)
        known.reset()
        met = np.zeros(0, dtype=np.int64)
        for part in _slices(batches):
            texts = [value.as_py() for value in part.column(1)]
            rows = [known.numbers(text) if text else met[:0] for text in texts]
            known.settle()
            rows = [row if known.valid[row].all() else row[:0] for row in rows]
            flat, ends = np.concatenate(rows), np.cumsum([len(row) for row in rows])
            met = np.concatenate([met, np.zeros(len(known) - len(met), dtype=np.int64)])
            met += np.bincount(flat, minlength=len(met))

            def per_row(counts):
                return np.diff(np.append(0, np.concatenate([[0], np.cumsum(counts)])[ends]))

            sizes = known.sizes[flat]
            ones, pairs = known.ones.only(flat), known.pairs.only(flat)
            names = [hashlib.sha256(";".join([known.groups[k] for k in row.tolist()]).encode()).hexdigest()
                     if len(row) else "" for row in rows]
            n_pairs = per_row(pairs.lengths)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(per_row(sizes[:, k])) for k in range(4)), pa.array(names, pa.string()),
                 _binary(ones.values, per_row(ones.lengths), kinds[0]),
                 _binary(pairs.values >> 32, n_pairs, kinds[0]), _binary(pairs.values & 0xFFFFFFFF, n_pairs, kinds[1])],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ones", "left", "right"])
            if known.chars > cache:
                known.shrink(met > 1)
                met = np.zeros(len(known), dtype=np.int64)
                if known.chars > cache // 2:
                    known.reset()
                    met = met[:0]

    return docs.select("doc_id", "text").mapInArrow(run, """doc_id long, n_a long, n_b long, n_groups long, n_links long,
        groups_sha256 string, ones binary, left binary, right binary""")


def _links(batch, kinds):
    """The links of encoded rows: ones, left, right, each with the lengths of its rows."""
    for name, kind in zip(("ones", "left", "right"), (kinds[0], *kinds)):
        values = batch.column(batch.schema.get_field_index(name)).to_pylist()
        yield (np.frombuffer(b"".join(values), dtype=kind).astype(np.int64),
               np.array([len(x) for x in values], dtype=np.int64) // np.dtype(kind).itemsize)


def pair_counts(encoded, same, kinds):
    """Rows (a, b, n, best): how many links hold an id pair, and whether no pair of the same b has more."""
    def run(batches):
        vector, held, size = np.zeros(len(same), dtype=np.int64), [], 0

        def rows(a, b, n):
            hit = n > 0
            return pa.RecordBatch.from_arrays([pa.array(x[hit].astype(np.int64)) for x in (a, b, n)], names=["a", "b", "n"])

        def summed():
            codes, n = np.unique(np.concatenate(held or [vector[:0]]), return_counts=True)
            return rows(codes >> 32, codes & 0xFFFFFFFF, n)

        for batch in _slices(batches):
            (ones, _), (left, _), (right, _) = _links(batch, kinds)
            vector += np.bincount(ones, minlength=len(vector))
            held.append(left << 32 | right)
            size += len(left)
            if size > 4_000_000:
                yield summed()
                held, size = [], 0
        yield summed()
        yield rows(np.arange(len(vector)), same, vector)

    counted = (encoded.select("ones", "left", "right").mapInArrow(run, "a long, b long, n long")
               .groupBy("a", "b").agg(F.sum("n").alias("n")))
    counted = cut(counted, "pair-counts")
    highest = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


class Counts:
    """A block of pair counts."""

    def __init__(self, table, same):
        codes = table["a"].to_numpy() << 32 | table["b"].to_numpy()
        order = np.argsort(codes)
        self.codes = codes[order]
        self.values = np.stack([table["best"].to_numpy()[order].astype(np.int64), table["n"].to_numpy()[order]], axis=1)
        self.vector = self.of_pairs(np.where(same >= 0, np.arange(len(same)) << 32 | same, -1))

    def of_pairs(self, codes):
        """(best, n) of pairs; zeros for those of another block."""
        if not len(self.codes):
            return np.zeros((len(codes), 2), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return self.values[place] * (self.codes[place] == codes)[:, None]


def _measure(encoded, sent, same, kinds):
    """n_best and count_sum of every row next to its other columns, sums over the pairs of one block."""
    names, kept = encoded.columns[:-3], encoded.dtypes[:-3]

    def run(batches):
        counts = Counts(sent.value, same)
        for batch in _slices(batches):
            sums = np.zeros((batch.num_rows, 2), dtype=np.int64)
            (ones, n_ones), (left, n_pairs), (right, _) = _links(batch, kinds)
            for values, lengths in ((counts.vector[ones], n_ones), (counts.of_pairs(left << 32 | right), n_pairs)):
                totals = np.concatenate([np.zeros((1, 2), dtype=np.int64), np.cumsum(values, axis=0)])
                sums += np.diff(totals[np.append(0, np.cumsum(lengths))], axis=0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=[*names, "n_best", "count_sum"])

    columns = [f"{name} {kind}" for name, kind in kept] + ["n_best long", "count_sum long"]
    return encoded.mapInArrow(run, ", ".join(columns))


def align(docs, path_a, path_b, block=BLOCK, cache=CACHE):
    """Per document the numbers of tokens, groups and links, and what the corpus-wide pair counts say of its links.

    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most
    frequent of its B id), count_sum (pair counts summed over links) and
    groups_sha256 (of the ids of all groups in order).
    """
    spark, known = docs.sparkSession, aligner(path_a, path_b)
    same = known.same
    kinds = ["<u2" if len(table) <= 1 << 16 else "<u4" for table in (known.bytes_a, known.bytes_b)]
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    encoded = cut(encode(docs, path_a, path_b, kinds, cache), "encoded")
    pairs = cut(pair_counts(encoded, same, kinds), "pairs")
    blocks = max(1, -(-pairs.count() // block))

    def send(number):
        chosen = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(blocks)) == number)
        return spark.sparkContext.broadcast(chosen.toArrow())

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if blocks == 1:
        return _measure(encoded, send(0), same, kinds).select(names)
    rows = cut(encoded.select(F.monotonically_increasing_id().alias("row"), "*"), "encoded-rows")
    links = rows.select("row", "ones", "left", "right")
    found = functools.reduce(lambda x, y: x.unionByName(y), [
        _measure(links, send(number), same, kinds) for number in range(blocks)])
    sums = found.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    return rows.drop("ones", "left", "right").join(sums, "row").select(names)
