"""What packed rows must obey."""

import struct
import zlib
from collections import Counter

import brute


def packing_faults(rows, texts, capacity=4096):
    ids = {d: i + [1] for (d, _), i in zip(texts, brute.token_ids([t for _, t in texts]))}
    faults, sequences, seen = [], {}, Counter()
    for doc, piece, start, length, crc, sequence, offset in rows:
        own = ids[doc][start : start + length]
        if (len(own), start, zlib.crc32(struct.pack(f"<{len(own)}I", *own))) != (length, piece * capacity, crc):
            faults.append(doc)
        seen[doc] += length
        sequences.setdefault(sequence, []).append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            if offset != at:
                faults.append(parts)
            at += length
        if at > capacity:
            faults.append(parts)
    assert seen == {d: len(i) for d, i in ids.items()} and not faults
    return len(sequences), -(-sum(seen.values()) // capacity)
