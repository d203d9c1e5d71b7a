"""Sparse feature vectors as flat arrays inside a task."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F


def entry_columns(x):
    """The vector's slots and values as arrays; dense vectors number their slots."""
    vector = F.unwrap_udt(F.col(x))
    dense = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    # sequence counts down for an empty dense vector, which has no entries
    slots = F.when(vector["type"] == 0, vector["indices"]).when(F.size(vector["values"]) > 0, dense).otherwise(F.array())
    return slots.alias("slots"), vector["values"].alias("values")


def entry_rows(df, x, *columns):
    return df.select(*columns, *entry_columns(x))


def vector_size(df, x):
    """The number of slots, from the first row's vector; 0 without rows."""
    first = df.select(x).head()
    return 0 if first is None else first[0].size


@dataclass
class Entries:
    """Entries of a batch of rows, in order of row and slot; ``zeros`` keeps those that say zero."""

    rows: int
    owner: np.ndarray
    slot: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, batch, zeros=False):
        slots, values = (batch.column(batch.schema.get_field_index(name)) for name in ("slots", "values"))
        owner = np.repeat(np.arange(len(batch)), np.diff(slots.offsets.to_numpy()))
        slot, value = (x.flatten().to_numpy(zero_copy_only=False) for x in (slots, values))
        if zeros:
            return cls(len(batch), owner, slot.astype(np.int64), value)
        kept = value != 0
        return cls(len(batch), owner[kept], slot[kept].astype(np.int64), value[kept])

    def look_up(self, rows, slots):
        """The values at (row, slot); 0 where there is no entry."""
        if not len(self.slot):
            return np.zeros(len(rows))
        wide = int(max(self.slot.max(), slots.max(initial=0))) + 1
        keys = self.owner * wide + self.slot
        wanted = rows * wide + slots
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, self.value[at], 0.0)


def column(batch, name, kind):
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(kind)
