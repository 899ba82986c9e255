"""Size limits that choose between equivalent plans.

None of them changes a result: they only decide which of several exact plans is
used.  Tests pass tiny values to run the large-data plans on small fixtures.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    # A join side is broadcast only if its measured size is at most this.
    broadcast_bytes: int = 256 * 1024 * 1024
    # A key is "hot" if it holds at least this share of all rows; what stays
    # below it is left to the adaptive skew handling of Spark.
    hot_share: float = 0.0002
    # Items tracked by the frequent-key sketch; its error is about 3.5 / items
    # of the rows, which must stay well below hot_share.
    sketch_items: int = 65536
    # Sketches are merged in this many groups before the final merge.
    sketch_groups: int = 64
    # A window over a frame of at most this many rows fits one task whatever
    # the skew, so no search for hot groups is needed.
    window_rows: int = 4_000_000
    # A dimension that is too big for a broadcast as it is becomes blocks (see
    # ``operators.blocks``) only if it has at least this many members: they take
    # two jobs, which a small shuffle does not cost.
    block_rows: int = 100_000


DEFAULT = Limits()
