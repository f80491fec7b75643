"""Skills of postings as they arrive."""

import time

from ..fixed_values import PROCESSED_FIELDS
from ..operators.extract import extract_skills, small_phrases
from ..sinks.tables import with_text_lists


def process_postings(postings, taxonomy):
    """The six output fields, lists as ``;`` text.

    The batch extractor works inside the row, so the same plan runs on a batch
    and on a stream.
    """
    return with_text_lists(extract_skills(postings, taxonomy).select(*PROCESSED_FIELDS))


def start_extraction(postings, taxonomy, path, checkpoint, available_now=True, every="10 seconds"):
    """Append the results to a Parquet table.

    The file sink and the checkpoint commit each batch once, so a restart neither loses nor
    repeats a message. A vocabulary too large for the plan is joined batch by batch; each
    batch then replaces a folder of its own number below ``path``.
    """
    if small_phrases(taxonomy) is None:
        def extract(batch, number):
            process_postings(batch, taxonomy).write.mode("overwrite").parquet(f"{path}/batch={number}")
        writer = postings.writeStream.foreachBatch(extract)
    else:
        writer = (process_postings(postings, taxonomy).writeStream.format("parquet")
                  .outputMode("append").option("path", path))
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_until_idle(query, idle_seconds=60):
    """Wait until no message has come for ``idle_seconds``, then stop.

    Only time without data at hand counts: a batch that runs longer than the idle time is
    not cut off. Looking for new data does not count as work.
    """
    since = time.monotonic()
    while query.isActive and time.monotonic() - since < idle_seconds:
        status = query.status
        if status["isDataAvailable"] or status["message"].startswith("Initializing"):
            since = time.monotonic()
        query.awaitTermination(min(0.2, idle_seconds / 5))
    query.stop()
