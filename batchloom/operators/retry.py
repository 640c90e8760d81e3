"""Plan the retry of failed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.functions.text import to_integer

# The retry policy.
MAX_ATTEMPTS = 5
BASE_DELAY_SECONDS = 2.0
MAX_DELAY_SECONDS = 60.0
RETRYABLE_WORDS = [
    "rate limit", "429", "500", "502", "503", "504",
    "timeout", "connection", "reset", "broken pipe",
]


def retry_plan(errors: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Add what happens next to each error: retry after a delay, or dead_letter.

    A numeric 4xx code other than 429 is the caller's fault and never retried; all else is retried
    if code or message names a transient fault, until the attempts are used up. ``attempt`` counts
    the tries so far (1 if there is no such column).
    """
    attempt = F.col("attempt") if "attempt" in errors.columns else F.lit(1)
    code = to_integer(F.col("error_code"))
    client_fault = F.coalesce((code >= 400) & (code < 500) & (code != 429), F.lit(False))
    said = F.lower(F.concat_ws(" ", "error_code", "error_message"))
    transient = F.greatest(*[F.contains(said, F.lit(w)) for w in RETRYABLE_WORDS])
    again = ~client_fault & transient & (attempt < max_attempts)
    delay = F.least(F.lit(BASE_DELAY_SECONDS) * F.pow(F.lit(2.0), attempt - 1), F.lit(MAX_DELAY_SECONDS))
    return errors.withColumns(
        {
            "retryable": ~client_fault & transient,
            "action": F.when(again, "retry").otherwise("dead_letter"),
            "next_attempt": F.when(again, attempt + 1),
            "next_delay": F.when(again, delay),
        }
    )


def failed_requests(errors: DataFrame, requests: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The retry plan with each request's own line, ready to be sent again."""
    lines = requests.select("custom_id", "request")
    return retry_plan(errors, max_attempts).join(lines, "custom_id", "left")
