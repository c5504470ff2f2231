"""Media columns: MPEG transport streams.

`store_media` packs a payload into a stream (program tables, elementary packets
with timestamps, random-access points, continuity counters); `read_media` finds
the program, checks the counters, puts the elementary packets together again
and gives the payload with its index of timestamps.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, slices, stored


#: Fixed values of the format.
PACKET, SYNC, PAT_PID, PMT_PID, ES_PID, PRIVATE_STREAM = 188, 0x47, 0x0000, 0x1000, 0x0100, 0xBD
CLOCK, FRAME = 90_000, 3_600
INDEX = "array<struct<pts:bigint,at:bigint,random_access:boolean>>"


def crc32_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def section_packet(pid: int, table: int, body: bytes) -> bytes:
    """One packet with a program table of one section."""
    section = struct.pack(">BH", table, 0xB000 | len(body) + 9) + struct.pack(">HBBB", 1, 0xC1, 0, 0) + body
    section += struct.pack(">I", crc32_mpeg(section))
    return (struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + b"\0" + section).ljust(PACKET, b"\xff")


TABLES = section_packet(PAT_PID, 0x00, struct.pack(">HH", 1, 0xE000 | PMT_PID)) + section_packet(PMT_PID, 0x02, struct.pack(">HHBHH", 0xE000 | ES_PID, 0xF000, 0x06, 0xE000 | ES_PID, 0xF000))


def pts_bytes(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, pts >> 14 & 0xFE | 1, pts >> 7 & 0xFF, pts << 1 & 0xFE | 1])


def mux(payload: bytes, unit: int = 32 << 10, random_access_every: int = 4) -> bytes:
    """The stream of a payload: one elementary packet for each unit of bytes."""
    out, counter = [TABLES], 0
    for k, start in enumerate(range(0, max(1, len(payload)), unit)):
        chunk, pts = payload[start : start + unit], k * FRAME & (1 << 33) - 1
        data = b"\0\0\1" + struct.pack(">BHBBB", PRIVATE_STREAM, len(chunk) + 8, 0x84, 0x80, 5) + pts_bytes(pts) + chunk
        first = bytes()
        if k % random_access_every == 0:  # an adaptation field with the random-access flag and the clock
            first = bytes([7, 0x50]) + struct.pack(">IH", pts >> 1, (pts & 1) << 15 | 0x7E00)
        n = 1 + max(0, -(-(len(data) - (184 - len(first))) // 184))
        packets = np.full((n, PACKET), 0xFF, np.uint8)
        packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, ES_PID >> 8, ES_PID & 0xFF
        packets[0, 1] |= 0x40
        packets[:, 3] = 0x10 | (counter + np.arange(n)) & 0x0F
        counter += n
        at = np.full(n, 4)
        if first:
            packets[0, 3] |= 0x20
            packets[0, 4 : 4 + len(first)] = np.frombuffer(first, np.uint8)
            at[0] += len(first)
        short = int((PACKET - at).sum()) - len(data)
        if short:  # the last packet is filled up within its adaptation field
            packets[-1, 3] |= 0x20
            if n == 1 and first:
                packets[0, 4] += short
            else:
                packets[-1, 4] = short - 1
                packets[-1, 5:6] = 0 if short > 1 else packets[-1, 5:6]
            at[-1] += short
        packets[np.arange(PACKET) >= at[:, None]] = np.frombuffer(data, np.uint8)
        out.append(packets.tobytes())
    return b"".join(out)


def section(packet: np.ndarray, table: int) -> bytes:
    """The body of the section that a packet holds."""
    raw = packet.tobytes()
    start = 4 + (1 + raw[4] if raw[3] & 0x20 else 0)
    start += 1 + raw[start]
    size = 3 + (struct.unpack_from(">H", raw, start + 1)[0] & 0x0FFF)
    whole = raw[start : start + size]
    if whole[0] != table or whole not in CHECKED and crc32_mpeg(whole):
        raise ValueError("damaged program table")
    if len(CHECKED) < 1000:
        CHECKED.add(whole)
    return whole[8:-4]


CHECKED: set[bytes] = set()


def demux(stream: bytes) -> tuple[bytes, list[tuple[int, int, bool]], int]:
    """(payload, [(pts, place in the payload, random access)], continuity errors) of the first program's first stream."""
    packets = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (packets[:, 0] != SYNC).any():
        raise ValueError("sync byte is missing")
    pid = (packets[:, 1].astype(np.int64) & 0x1F) << 8 | packets[:, 2]
    pmt = struct.unpack_from(">H", section(packets[np.argmax(pid == PAT_PID)], 0x00), 2)[0] & 0x1FFF
    body = section(packets[np.argmax(pid == pmt)], 0x02)
    es = struct.unpack_from(">H", body, 4 + (struct.unpack_from(">H", body, 2)[0] & 0x0FFF) + 1)[0] & 0x1FFF
    packets = packets[pid == es]
    adapted = (packets[:, 3] & 0x20) > 0
    packets, adapted = packets[(packets[:, 3] & 0x10) > 0], adapted[(packets[:, 3] & 0x10) > 0]
    # a packet may be sent twice; the second has the same counter and bytes
    again = np.concatenate([[False], (packets[1:] == packets[:-1]).all(1)])
    packets, adapted = packets[~again], adapted[~again]
    counters = packets[:, 3] & 0x0F
    errors = int(((np.diff(counters.astype(np.int64)) & 0x0F) != 1).sum())
    at = np.where(adapted, 5 + packets[:, 4].astype(np.int64), 4)
    random_access = adapted & (packets[:, 4] > 0) & ((packets[:, 5] & 0x40) > 0)
    data = packets[np.arange(PACKET) >= at[:, None]].tobytes()
    ends = np.cumsum(PACKET - at)
    starts = np.flatnonzero(packets[:, 1] & 0x40)
    bounds = [*(ends[starts] - (PACKET - at[starts])).tolist(), len(data)]
    parts, index, place = [], [], 0
    for a, b, access in zip(bounds, bounds[1:], random_access[starts].tolist(), strict=False):
        code, stream_id, size, _, flags, extra = struct.unpack_from(">3sBHBBB", data, a)
        if code != b"\0\0\1" or size and size != b - a - 6:
            raise ValueError("damaged elementary packet")
        p = data[a + 9 : a + 14]
        pts = (p[0] >> 1 & 7) << 30 | p[1] << 22 | p[2] >> 1 << 15 | p[3] << 7 | p[4] >> 1 if flags & 0x80 else -1
        index.append((pts, place, access))
        parts.append(data[a + 9 + extra : b])
        place += len(parts[-1])
    return b"".join(parts), index, errors


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 64) -> DataFrame:
    """(id, n_bytes, media): the text's UTF-8 bytes, with bytes 0 up to a positive multiple of block, as a transport stream, written to the shared folder.

    Null texts count as empty; each row of docs gives one, whatever its id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("text"))
    schema = f"id {named.schema['id'].dataType.simpleString()}, n_bytes long, media binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            raw = batch.column("text").to_pylist()
            media = [mux(x.ljust(max(1, -(-len(x) // block)) * block, b"\0")) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(out.field("id").type), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], schema=out)

    return stored(named.mapInArrow(run, schema), "media").withColumnRenamed("id", id_col)


def read_media(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, media, payload, pts_index, continuity_errors) of stored streams; a damaged stream fails the job."""
    named = media.select(F.col(id_col).alias("id"), "n_bytes", "media")
    schema = f"id {named.schema['id'].dataType.simpleString()}, n_bytes long, media binary, payload binary, pts_index {INDEX}, continuity_errors int"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 2 << 20):
            read = [demux(x) for x in batch.column("media").to_pylist()]
            index = [[{"pts": p, "at": a, "random_access": r} for p, a, r in x[1]] for x in read]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field("id").type), batch.column(1), batch.column(2), pa.array([x[0] for x in read], pa.binary()), pa.array(index, out.field("pts_index").type), pa.array([x[2] for x in read], pa.int32())], schema=out)

    return named.mapInArrow(run, schema).withColumnRenamed("id", id_col)
