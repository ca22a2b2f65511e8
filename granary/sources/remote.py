"""Batched requests to services that answer in pages, as partitioned Spark reads.

A transport is any picklable function from a request (a dict of parameters) to
the answer's text. Requests run in tasks, each key list in one of them; lists
that fail are halved, and what fails alone is reported instead of raised.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.stored import stored

Transport = Callable[[dict[str, str]], str]


class NotThere(Exception):
    """Raised by a transport where there is no such record; it is not asked for again, and gives no row."""


class RetryLater(Exception):
    """Raised by a transport that was told to wait; seconds may be known."""

    def __init__(self, seconds: float | None = None) -> None:
        super().__init__(seconds)
        self.seconds = seconds


@dataclass(frozen=True)
class Policy:
    batch: int = 50
    retries: int = 3
    pause: float = 0.5
    tasks: int = 8


def answered(transport: Transport, request: dict[str, str], policy: Policy, sleep: Callable[[float], None] = time.sleep) -> str:
    for attempt in range(policy.retries + 1):
        try:
            return transport(request)
        except RetryLater as e:
            if attempt == policy.retries:
                raise
            sleep(e.seconds if e.seconds is not None else policy.pause * 2**attempt)
        except OSError:
            if attempt == policy.retries:
                raise
            sleep(policy.pause * 2**attempt)
    raise AssertionError


def split_requests(keys: list[str], ask: Callable[[list[str]], str]) -> Iterator[tuple[list[str], str | None, str | None]]:
    """(keys, answer, error) for keys, halved as long as a list of several fails."""
    try:
        yield keys, ask(keys), None
    except Exception as e:
        if len(keys) == 1:
            yield keys, None, f"{type(e).__name__}: {e}"
        else:
            yield from split_requests(keys[: len(keys) // 2], ask)
            yield from split_requests(keys[len(keys) // 2 :], ask)


def fetch(keys: DataFrame, key: str, build: Callable[[list[str]], dict[str, str]], transport: Transport, policy: Policy) -> DataFrame:
    """(keys, body, error) for the distinct keys, in batches; at most ``policy.tasks`` requests at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch[key].tolist()
            for i in range(0, len(own), policy.batch):
                ask = lambda k: answered(transport, build(k), policy)
                yield pd.DataFrame(list(split_requests(own[i : i + policy.batch], ask)), columns=["keys", "body", "error"])

    wanted = keys.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    return wanted.repartition(policy.tasks, key).mapInPandas(run, "keys array<string>, body string, error string")


def page_starts(totals: DataFrame, size: int, first: int = 1) -> DataFrame:
    """A row for each further page of queries whose first answer said how many records there are."""
    last = F.col("n_records") - 1 + first
    pages = F.filter(F.sequence(F.lit(first), F.greatest(last, F.lit(first)), F.lit(size)), lambda s: s > first)
    return totals.withColumn("start", F.explode(pages))


def ask_each(requests: DataFrame, build: Callable[[dict], dict[str, str]], transport: Transport, policy: Policy) -> DataFrame:
    """requests with body and error, a row for each that is there; build makes a row's parameters. At most
    ``policy.tasks`` requests at a time, dealt by their columns."""
    names = requests.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                try:
                    body, error = answered(transport, build(row), policy), None
                except NotThere:
                    continue
                except Exception as e:
                    body, error = None, f"{type(e).__name__}: {e}"
                yield pd.DataFrame([[row[c] for c in names] + [body, error]], columns=[*names, "body", "error"])

    schema = T.StructType([*requests.schema.fields, T.StructField("body", T.StringType()), T.StructField("error", T.StringType())])
    return requests.repartition(policy.tasks, *names).mapInPandas(run, schema)


def ask_with_repair(requests: DataFrame, build: Callable[[dict], dict[str, str]], transport: Transport, policies: Sequence[Policy]) -> DataFrame:
    """As ask_each; what fails is asked for again by the next policy, usually with fewer tasks and longer pauses.

    Answers are stored, so that nothing is asked for twice because a table is read twice.
    """
    done = stored(ask_each(requests, build, transport, policies[0]), "answers")
    for policy in policies[1:]:
        failed = done.filter("error IS NOT NULL").select(*requests.columns)
        if failed.isEmpty():
            break
        again = stored(ask_each(failed, build, transport, policy), "answers")
        done = done.filter("error IS NULL").unionByName(again)
    return done


def _said(path: str) -> Column:
    return F.xpath_string("body", F.lit(path)).try_cast("long")


def ask_for_pages(
    keys: DataFrame, key: str, build: Callable[[dict], dict[str, str]], transport: Transport, policies: Sequence[Policy], size: int = 50, first: int = 1
) -> DataFrame:
    """(key, start, body, error): all pages of every distinct key's answer, in two phases.

    First the page that begins at ``first`` is asked for; its envelope says how many records there are, and from that
    follow the starts of further pages, which are requests of their own. An answer that does not say how many counts as
    one page. build gets a row with the key and start.
    """
    wanted = keys.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    opening = ask_with_repair(wanted.withColumn("start", F.lit(first).cast("long")), build, transport, policies)
    known = opening.filter("error IS NULL").select(key, _said("//*[local-name()='numberOfRecords']").alias("n_records")).filter("n_records IS NOT NULL")
    further = page_starts(known, size, first).select(key, F.col("start").cast("long").alias("start"))
    return opening.unionByName(ask_with_repair(further, build, transport, policies))


def page_totals(pages: DataFrame, key: str) -> DataFrame:
    """(key, n_records, n_received, n_failed, complete): what each key's first page promised, and what came."""
    received = F.xpath_int("body", F.lit("count(//*[local-name()='recordData'])"))
    each = pages.withColumns({"_promised": _said("//*[local-name()='numberOfRecords']"), "_came": F.coalesce(received, F.lit(0))})
    by = each.groupBy(key).agg(
        F.min_by("_promised", "start").alias("n_records"), F.sum("_came").alias("n_received"), F.count_if(F.col("error").isNotNull()).alias("n_failed")
    )
    return by.withColumn("complete", (F.col("n_failed") == 0) & (F.col("n_received") >= F.coalesce("n_records", F.lit(0))))
