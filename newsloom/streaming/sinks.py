"""Stream sinks. Each returns the started query."""


def _writer(df, output_mode, trigger_interval, available_now):
    writer = df.writeStream.outputMode(output_mode)
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger_interval:
        return writer.trigger(processingTime=trigger_interval)
    return writer


def write_console(
    df, output_mode="append", trigger_interval=None, available_now=False, num_rows=20, truncate=True
):
    writer = _writer(df, output_mode, trigger_interval, available_now).format("console")
    return writer.option("numRows", num_rows).option("truncate", str(truncate).lower()).start()


def preview(df, num_rows=20, truncate=False):
    return write_console(df, num_rows=num_rows, truncate=truncate)


def write_memory(df, name, output_mode="append", trigger_interval=None, available_now=False):
    """Into a driver-side table: for tests and looking at small results only."""
    return _writer(df, output_mode, trigger_interval, available_now).format("memory").queryName(name).start()


def write_files(df, path, checkpoint=None, trigger_interval=None, available_now=False, fmt="parquet"):
    """Append to files. The checkpoint sits beside the data unless given."""
    writer = _writer(df, "append", trigger_interval, available_now).format(fmt)
    return writer.option("path", path).option("checkpointLocation", checkpoint or f"{path}/checkpoint").start()


def run_bounded(query, timeout=None):
    """Wait for ``query`` up to ``timeout`` seconds and stop it if it still runs.

    True if it ended by itself.
    """
    ended = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if query.isActive:
        query.stop()
    return bool(ended) if timeout else True
