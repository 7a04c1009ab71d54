"""Audio features of byte payloads: resampling, log-mel filterbanks, energy segments.

A payload is stored losslessly as an 8-bit mono PCM WAV and read back. The samples
are resampled by a polyphase filter, cut into overlapping windowed frames and
turned into log-mel energies. Loud segments begin where a frame's energy passes the
upper threshold and end where it falls below the lower one; the thresholds stand
around the mean of the frames that hold text alone, so the fill has no say in them.
What lies between is quiet segments, so every frame is in one. A segment's frames
are the rows of tensors of fixed shape, as many tensors as it takes; these, their
time spans and kind are stored as an Arrow stream with the fixed-shape tensor type.

Defined results: a null or empty text is a payload of one unit of fill bytes; equal
texts have equal values; an empty table gives an empty result; other columns are
not read. Samples are worked on in chunks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import per_process, saved

UNIT, FILL = 576, b"\xff"
RATE, UP, DOWN = 16_000, 1, 2
FRAME, HOP, MELS = 256, 128, 24
#: Frames worked on at once.
CHUNK = 1024
#: Rows of a tensor, one frame each; rows past the last frame repeat frames.
SPANS = 8
#: Decibels above the mean frame energy of the text at which a segment begins, and below which it ends.
BEGIN_DB, END_DB = 0.4, 0.0


def payload_of(text: str) -> tuple[int, bytes]:
    """Bytes of text in UTF-8, and these with fill bytes up to a positive multiple of UNIT."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    return len(raw), raw.ljust(size, FILL)


def wav(payload: bytes, rate: int = RATE) -> bytes:
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload


def samples_of(media: bytes) -> bytes:
    """The 8-bit samples in a WAV."""
    at = 12
    while at < len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filter phases (UP x taps), window, mel filters (bins x MELS)."""
    kept, key = per_process(), f"audio {UP}/{DOWN}"
    if key not in kept:
        half = UP * -(-8 * max(UP, DOWN) // UP)  # whole input samples, so phase p is p past an input sample
        n = np.arange(-half, half + 1)
        low = np.sinc(n / max(UP, DOWN)) * np.hamming(2 * half + 1)
        low *= UP / low.sum()
        taps = -(-len(low) // UP)
        phases = np.zeros((UP, taps))
        for p in range(UP):
            phases[p, : len(low[p::UP])] = low[p::UP]
        mel = lambda f: 2595 * np.log10(1 + f / 700)
        edges = 700 * (10 ** (np.linspace(mel(50), mel(RATE * UP / DOWN / 2), MELS + 2) / 2595) - 1)
        f = np.fft.rfftfreq(FRAME, DOWN / (RATE * UP))[:, None]
        left, mid, right = edges[:-2], edges[1:-1], edges[2:]
        kept[key] = phases, np.hanning(FRAME), np.maximum(0, np.minimum((f - left) / (mid - left), (right - f) / (right - mid)))
    return kept[key]


def resampled(x: np.ndarray) -> np.ndarray:
    """x at UP / DOWN of its rate: output k is phase k * DOWN mod UP of the filter over the input around k * DOWN / UP."""
    phases = tables()[0]
    taps = phases.shape[1]
    n = -(-len(x) * UP // DOWN)
    pad = np.concatenate([np.zeros(taps // 2), x, np.zeros(taps + DOWN)])
    view = np.lib.stride_tricks.sliding_window_view(pad, taps)
    out = np.empty(n)
    for lo in range(0, n, CHUNK * HOP):
        k = np.arange(lo, min(n, lo + CHUNK * HOP))
        for p in range(UP):
            own = k[(k * DOWN) % UP == p]
            out[own] = np.einsum("ij,j->i", view[own * DOWN // UP], phases[p, ::-1])
    return out


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel energies in dB (frames x MELS) and frame energies in dB; frame k is centred on sample k * HOP, so the ends have weight too."""
    _, window, filters = tables()
    half = FRAME // 2
    frames = 1 + -(-len(y) // HOP)
    y = np.concatenate([np.zeros(half), y, np.zeros(half + HOP * (frames - 1) - len(y))])
    view = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    mels, energy = [], []
    for lo in range(0, frames, CHUNK):
        part = view[lo : min(frames, lo + CHUNK)]
        power = np.abs(np.fft.rfft(part * window)) ** 2
        mels.append(10 * np.log10(np.einsum("ij,jk->ik", power, filters) + 1e-10))
        energy.append(10 * np.log10((part * part).mean(1) + 1e-10))
    return np.round(np.concatenate(mels), 2), np.round(np.concatenate(energy), 2)


def segments(energy: np.ndarray, mean: float | None = None) -> list[tuple[int, int]]:
    """First frame and the one past the last of what is loud, by two thresholds around the mean energy."""
    mean, out, begun = energy.mean() if mean is None else mean, [], None
    high, low = energy > mean + BEGIN_DB, energy < mean + END_DB
    for k in np.flatnonzero(high | low).tolist():
        if begun is None and high[k]:
            begun = k
        elif begun is not None and low[k]:
            out.append((begun, k))
            begun = None
    return out + ([(begun, len(energy))] if begun is not None else [])


def text_mean(energy: np.ndarray, n: int) -> float:
    """Mean energy of the frames that hold nothing but the first n payload bytes; for shorter texts, of those centred on them."""
    end, half = n * UP / DOWN, FRAME // 2
    centre = np.arange(len(energy)) * HOP
    for own in ((centre >= half) & (centre + half <= end), centre <= end):
        if own.any():
            return energy[own].mean()
    return energy.mean()


def pieces(loud: list[tuple[int, int]], frames: int) -> list[tuple[int, int, bool]]:
    """The loud segments and the quiet ones between them, cut to SPANS frames at most; together they hold every frame once."""
    out, at = [], 0
    for a, b, kind in [(a, b, True) for a, b in loud] + [(frames, frames, True)]:
        out += [(at, a, False), (a, b, kind)]
        at = b
    return [(lo, min(b, lo + SPANS), kind) for a, b, kind in out for lo in range(a, b, SPANS)]


def tensors(mels: np.ndarray, spans: list[tuple[int, int, bool]]) -> pa.RecordBatch:
    """The time span in seconds, a SPANS x MELS tensor and whether it is loud for each piece."""
    a, b, loud = (np.array(x) for x in zip(*spans, strict=True))
    out = mels[a[:, None] + (b - a)[:, None] * np.arange(SPANS) // SPANS].astype(np.float32)
    kind = pa.fixed_shape_tensor(pa.float32(), [SPANS, MELS])
    flat = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), SPANS * MELS)
    hop = HOP * DOWN / (RATE * UP)
    times = [pa.array(np.maximum(0, t - 0.5) * hop, pa.float64()) for t in (a, b)]
    return pa.RecordBatch.from_arrays([*times, pa.ExtensionArray.from_storage(kind, flat), pa.array(loud)], ["begin_s", "end_s", "log_mel", "loud"])


def features_of(n: int, payload: bytes) -> pa.RecordBatch:
    """The tensors of a payload whose first n bytes are text."""
    x = (np.frombuffer(payload, np.uint8).astype(np.float64) - 128) / 128
    mels, energy = log_mel(resampled(x))
    return tensors(mels, pieces(segments(energy, text_mean(energy, n)), len(energy)))


def analysed(text: str) -> tuple[int, bytes, bytes]:
    """Unpadded bytes, and what is stored: the WAV and its features (an Arrow stream)."""
    n, payload = payload_of(text)
    return n, wav(payload), ipc(features_of(n, payload))


def ipc(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def described(media: bytes, features: bytes) -> tuple:
    """Payload bytes and digests of what is read from a stored WAV and its stored features."""
    back, f = samples_of(media), pa.ipc.open_stream(features).read_all()
    tensor = f["log_mel"].combine_chunks().storage.flatten().to_numpy(zero_copy_only=False)
    shown = hashlib.sha256(tensor.tobytes())
    shown.update(np.array([x for c in ("begin_s", "end_s", "loud") for x in f[c].to_pylist()], np.float64).tobytes())
    return len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), f"{f.num_rows} segments {shown.hexdigest()[:32]}"


STORED = "doc_id long, n_bytes long, media binary, features binary"
DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _rows(rows: DataFrame, kept: int, make, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """The first columns of rows, so many of them, and what make gives for the others."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                cols = zip(*[make(*x) for x in zip(*[c.to_pylist() for c in part.columns[kept:]], strict=True)], strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names)

    return rows.mapInArrow(run, schema)


def audio_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, the WAV and its features (an Arrow stream of begin_s, end_s, log_mel, loud) of every text."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _rows(texts, 1, lambda text: analysed(text or ""), STORED, [pa.int64(), pa.binary(), pa.binary()])


def audio_digests(docs: DataFrame) -> DataFrame:
    """Sizes and checksums of the media and features of every text, stored as a table and read back from it."""
    return _rows(saved(audio_media(docs)), 2, described, DIGESTS, [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])
