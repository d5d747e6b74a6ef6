"""Fill-in-middle: texts cut in three and put together anew by displacements of their bytes, and the way back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.shared import ship, whole
from lodestrata.llm.words import AT_ONCE

#: Marks of the parts in an output. All have three bytes, the middle one tells them apart.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = np.frombuffer(f"{PREFIX}{SUFFIX}{MIDDLE}".encode(), dtype=np.uint8).reshape(3, 3)
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM])
_P, _S, _M = range(3)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts without nulls, and the bounds of each text in them."""
    wide = texts.cast(pa.large_binary())
    bounds = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    body = wide.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The column of texts whose bytes and bounds these are."""
    wide = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(data)])
    return wide.cast(pa.string())


def runs_of_rows(sizes: np.ndarray, most: int = AT_ONCE) -> Iterator[slice]:
    """Runs of rows with at most ``most`` bytes together; a longer text is a run of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield slice(start, len(sizes))


def marks_in(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks that lie whole inside a text: their places, which of the three, and the row of the text."""
    if len(data) < 3:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    at = np.flatnonzero((data[:-2] == MARKS[0, 0]) & (data[2:] == MARKS[0, 2]))
    which = np.select([data[at + 1] == MARKS[k, 1] for k in range(3)], range(3), -1)
    row = np.searchsorted(bounds[1:], at, side="right")
    inside = (which >= 0) & (at + 3 <= bounds[1:][row])
    return at[inside], which[inside], row[inside]


def displaced(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The place of each of ``size`` bytes after its part's shift: a difference array over the starts of the parts, summed up.

    ``starts`` is in order; where parts are empty several begin at one byte and their differences add up to the last one's shift.
    """
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, np.diff(shifts, prepend=0))
    place = np.cumsum(steps[:size])
    place += np.arange(size)
    return place


def _laid_out(lengths: np.ndarray, spm: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the prefix, middle and suffix (columns of ``lengths``) go in outputs beginning at ``begin``, and the marks P, S and M."""
    first = np.where(spm, lengths[:, 2], lengths[:, 0])
    second = np.where(spm, lengths[:, 0], lengths[:, 2])
    lead, next_, last = begin, begin + 3 + first, begin + 6 + first + second
    prefix, suffix = np.where(spm, next_, lead), np.where(spm, lead, next_)
    return np.c_[prefix + 3, last + 3, suffix + 3], np.c_[prefix, suffix, last]


def scattered(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, plain_percent: int, spm_percent: int) -> tuple[np.ndarray, ...]:
    """Outputs of some texts: n, form, code points of prefix and middle, bytes, bounds. ``draws`` has four numbers a row."""
    start, stop = bounds[:-1], bounds[1:]
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(heads, start)
    n = np.searchsorted(heads, stop) - first
    cuts = np.sort(np.c_[draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)], axis=1)
    plain = (n == 0) | (draws[:, 2] % 100 >= 100 - plain_percent)
    plain[marks_in(data, bounds)[2]] = True
    spm = ~plain & (draws[:, 3] % 100 < spm_percent)

    lower, upper = heads[first + cuts[:, 0]], heads[first + cuts[:, 1]]
    lengths = np.c_[lower - start, upper - lower, stop - upper]
    out_bounds = np.r_[0, np.cumsum(stop - start + np.where(plain, 0, 9))]
    places, marks = _laid_out(lengths, spm, out_bounds[:-1])
    parts = np.c_[start, lower, upper]
    shifts = np.where(plain[:, None], (out_bounds[:-1] - start)[:, None], places - parts)
    out = np.empty(out_bounds[-1], dtype=np.uint8)
    out[displaced(parts.ravel(), shifts.ravel(), len(data))] = data
    for k in range(3):
        out[marks[~plain, k][:, None] + np.arange(3)] = MARKS[k]
    return n, np.where(plain, 0, np.where(spm, 2, 1)), cuts[:, 0], cuts[:, 1] - cuts[:, 0], out, out_bounds


def gathered(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts from outputs and their forms (places in FORMS): bytes, bounds, and which rows are sound.

    A row of another form than plain is sound if it has each mark once, in the order of its form and the first one at its
    beginning. Rows that aren't give no bytes.
    """
    start, stop = bounds[:-1], bounds[1:]
    at, which, row = marks_in(data, bounds)
    times = np.bincount(row * 3 + which, minlength=3 * len(form)).reshape(-1, 3)
    mark = np.zeros((len(form), 3), dtype=np.int64)
    mark[row, which] = at
    spm, plain = form == 2, form == 0
    lead, next_ = np.where(spm, mark[:, _S], mark[:, _P]), np.where(spm, mark[:, _P], mark[:, _S])
    sound = plain | ((times == 1).all(axis=1) & (lead == start) & (next_ > lead) & (mark[:, _M] > next_))
    # Bounds of prefix, middle and suffix in the output; a plain text is all prefix.
    begins = np.c_[mark[:, _P] + 3, mark[:, _M] + 3, mark[:, _S] + 3]
    ends = np.c_[np.where(spm, mark[:, _M], mark[:, _S]), stop, np.where(spm, mark[:, _P], mark[:, _M])]
    begins[plain], ends[plain] = start[plain, None], np.c_[stop, start, start][plain]
    begins[~sound], ends[~sound] = start[~sound, None], start[~sound, None]
    lengths = ends - begins
    text_bounds = np.r_[0, np.cumsum(lengths.sum(axis=1))]
    parts = text_bounds[:-1, None] + np.c_[np.zeros(len(form), np.int64), np.cumsum(lengths, axis=1)[:, :2]]
    source = displaced(parts.ravel(), (begins - parts).ravel(), text_bounds[-1])
    return data[source], text_bounds, sound


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", plain_percent: int = 10, spm_percent: int = 20, seed: str = "1") -> DataFrame:
    """Each whole text cut in three at two of its code points and put together for training a model to fill in the middle.

    Columns: ``id_col``, n (code points), form, prefix_chars, middle_chars (null if plain), output. Forms: psm,
    ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; spm, ``<S>`` suffix ``<P>`` prefix ``<M>`` middle; plain, the text as it is, for
    ``plain_percent`` of the rows and all texts that are empty or hold a mark. ``spm_percent`` of the others are spm. Cuts and forms come from
    sha256 of ``seed:id``, so reruns and other partitionings agree.

    The texts of a batch lie in one array of bytes. Cuts are found among the bytes that begin a code point; a difference array over the parts gives
    every byte its displacement, and one scatter builds all outputs. Arrays have the length of a portion of the batch, or of one text if it is
    longer; a text of any length is cut and moved whole.

    Null texts count as empty, a null id as the empty string in the hash. Rows that repeat an id and text give equal rows. An empty table gives an
    empty result. Other columns are not read, whatever their names.
    """
    ship(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    rows = docs.select(F.col(id_col).alias("id"), whole(text).alias("text"), *draws)
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            drawn = np.c_[tuple(batch.column(f"h{k}").to_numpy() for k in range(4))]
            for part in runs_of_rows(np.diff(bounds)):
                own = bounds[part.start : part.stop + 1]
                n, form, prefix, middle, out, out_bounds = scattered(data[own[0] : own[-1]], own - own[0], drawn[part], plain_percent, spm_percent)
                plain = form == 0
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").slice(part.start, part.stop - part.start),
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(FORMS[form].tolist(), pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64(), mask=plain),
                    "middle_chars": pa.array(middle, pa.int64(), mask=plain),
                    "output": texts_of(out, out_bounds),
                })

    made = rows.mapInArrow(cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text again, from an output and its form alone: the marks are looked up, and an inverse gather takes each byte from its place.

    Null where output or form is null, where the form is none of the three, or where the output does not have the marks of its form.
    """

    @F.arrow_udf("string")
    def text(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        names = forms.to_pylist()
        known = np.array([f in (PLAIN, PSM, SPM) for f in names], dtype=bool) & np.asarray(outputs.is_valid())
        data, bounds = bytes_of(outputs.fill_null(""))
        # An unknown form is looked at as psm and comes out null.
        form = np.array([{PLAIN: 0, SPM: 2}.get(f, 1) for f in names], dtype=np.int64)
        found = []
        for part in runs_of_rows(np.diff(bounds)):
            own = bounds[part.start : part.stop + 1]
            body, text_bounds, sound = gathered(data[own[0] : own[-1]], own - own[0], form[part])
            there = pa.array(sound & known[part])
            found.append(pa.compute.if_else(there, texts_of(body, text_bounds), pa.scalar(None, pa.string())))
        return pa.concat_arrays(found) if found else pa.array([], pa.string())

    return text(output, form)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT *, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(body, 1, a) AS pre, substring(body, a + 1, b - a) AS mid, substring(body, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM p
"""
