"""Rows of Python tasks as Arrow batches."""

import pyarrow as pa

TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
}


def schema_of(ddl):
    """Arrow schema of ``name type, name type``."""
    return pa.schema([(name, TYPES[kind]) for name, kind in map(str.split, ddl.split(", "))])


# Rows that a task turns into Python objects at once: a batch may hold many long texts.
ROWS_AT_ONCE = 256


def slices(batches, rows=ROWS_AT_ONCE):
    """The same batches in small pieces."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def to_batch(rows, ddl):
    """A batch of row tuples; integers stay whole where values are missing."""
    schema = schema_of(ddl)
    columns = zip(*rows) if rows else [()] * len(schema)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
