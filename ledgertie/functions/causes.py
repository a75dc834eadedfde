"""Root-cause labels and the action suggested for each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertie.functions.variance import PASS

# Labels and action texts that results must carry word for word.
DETAIL_ACTIONS = {
    "NONE": "No action",
    "FEED_NOT_RECEIVED": "Escalate to source-system owner: no detail received at all",
    "LATE_FEED": "Confirm load cutoff and re-run the missing batches",
    "DUPLICATE_LOAD": "Identify the replayed batch_id and reverse the duplicate load",
    "UNCLASSIFIED": "Manual review",
}
FILED_ACTIONS = {
    "NONE": "No action",
    "MISSING_FROM_EXTRACT": "GL balance never reached the filing - re-run the extract",
    "NOT_IN_GL": "Filed balance has no GL support - investigate before submission",
    "MAPPING_ERROR": "Correct the product mapping and refile the affected schedules",
    "TIMING_DIFFERENCE": "Late GL adjustment - re-run the extract after the posting date",
    "UNEXPLAINED_OVERSTATEMENT": "Manual review",
}


def cause_detail(status: Column, loans: Column, diff: Column) -> Column:
    """Label a detail break by what is absent or, failing that, by the variance's sign."""
    by_sign = F.when(diff < 0, "LATE_FEED").when(diff > 0, "DUPLICATE_LOAD")
    label = F.when(loans == 0, "FEED_NOT_RECEIVED").otherwise(
        F.coalesce(by_sign, F.lit("UNCLASSIFIED"))
    )
    return F.when(status == PASS, "NONE").otherwise(label)


def cause_filed(
    status: Column, missing_gl: Column, missing_extract: Column, partner: Column, diff: Column
) -> Column:
    """Label a filed break: presence first, then an offsetting partner, then the sign."""
    present = F.when(partner.isNotNull(), "MAPPING_ERROR").otherwise(
        F.when(diff < 0, "TIMING_DIFFERENCE").otherwise("UNEXPLAINED_OVERSTATEMENT")
    )
    one_sided = F.when(missing_extract == 1, "MISSING_FROM_EXTRACT").when(
        missing_gl == 1, "NOT_IN_GL"
    )
    return F.when(status == PASS, "NONE").otherwise(F.coalesce(one_sided, present))


def action(cause: Column, actions: dict[str, str]) -> Column:
    """The action text of a cause, from a fixed table of a few entries."""
    entries = [F.lit(word) for pair in actions.items() for word in pair]
    return F.create_map(*entries)[cause]
