"""Checkout messages booked once over several tables: purchases, items, people, access, tags, lifetime value.

`book` turns messages that the ledger does not hold into rows to add; nothing in them depends on rows of the tables but ids,
so a batch that runs again makes the same rows.  `Books.after` folds the tables of a start and any number of such additions;
a batch job folds one, a stream folds those of all its micro-batches, with equal results.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import filters
from growthloom.operators.joins import apart, or_lookup
from growthloom.plans.keyed import latest_by
from growthloom.plans.purchases import checkouts

ADDED = ("ledger", "skipped", "subscriptions", "purchases", "items", "people", "tags", "amounts")


def first_of(rows: DataFrame, key: str) -> DataFrame:
    """The earliest row of every key; rows without a key stay apart."""
    rest = [c for c in rows.columns if c != key]
    one = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("received_at", "id")).alias("_r"))
    return one.select(key, "_r.*").unionByName(rows.where(F.col(key).isNull()))


def person_id(email: Column) -> Column:
    """The id of a person first met in a message: the same whenever the message runs again."""
    return F.sha2(email, 256)


def fresh(rows: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Checkout rows whose message was not applied before, each message once."""
    one = first_of(rows.withColumn("message", F.col("id")), "message")
    return one.drop("message") if ledger is None else one.join(apart(ledger.select(F.col("id").alias("message"))), "message", "left_anti").drop("message")


def book(rows: DataFrame, products: DataFrame, subscribers: DataFrame, profiles: DataFrame,
         keep: Callable[[DataFrame], DataFrame] = lambda sold: sold) -> dict[str, DataFrame]:
    """What fresh checkout rows add to each table.

    `subscribers` and `profiles` need id and email.  A payment without a valid address books no person, tag or value; one whose
    product is unknown books a purchase without items or tag. `keep` may store the payments with product and buyer, from which
    most tables are made.
    """
    skipped, handled = filters.route(rows, F.col("skip"))
    subs, payments = filters.route(handled, F.col("mode") == "subscription")
    catalog = products.select(
        F.col("id").alias("product_id"), F.col("id").cast("string").alias("_pid"), "stripe_price_id", "product_type",
        F.get_json_object("file_urls", "$[0].url").alias("file"))
    sold = or_lookup(payments, catalog, [("meta_product_id", "_pid"), ("meta_price_id", "stripe_price_id")], ["product_id", "product_type", "file"])
    known_subs = subscribers.groupBy(F.col("email").alias("customer_email")).agg(F.min(F.col("id").cast("string")).alias("_sid"))
    known_profs = profiles.groupBy(F.col("email").alias("customer_email")).agg(F.min(F.col("id").cast("string")).alias("_prid"))
    made = F.when(X.valid_email("customer_email"), person_id(F.col("customer_email")))
    sold = sold.join(apart(known_subs), "customer_email", "left").join(apart(known_profs), "customer_email", "left").withColumns({
        "subscriber_id": F.coalesce("_sid", made), "profile_id": F.coalesce("_prid", made)})
    sold = keep(sold)
    person = sold.where("subscriber_id is not null")
    names = person.groupBy(F.col("customer_email").alias("email")).agg(
        F.min("subscriber_id").alias("subscriber_id"), F.min("profile_id").alias("profile_id"),
        F.min_by("customer_name", F.struct("received_at", "id")).alias("full_name"),
        F.max_by("stripe_customer_id", F.struct("received_at", "id")).alias("stripe_customer_id"),
        F.min("received_at").alias("created_at"), F.max("received_at").alias("updated_at"))
    slug = F.concat(F.lit("purchased-"), F.translate("product_type", "_", "-"))
    return {
        "ledger": rows.select("id", "received_at"),
        "skipped": skipped.select("id", "event_type", "reason"),
        "subscriptions": subs.select("id", "received_at", "session_id", "customer_email", "amount_cents"),
        "purchases": sold.select(
            "id", F.col("session_id").alias("processor_charge_id"), "product_id", "product_type", "matched_on", "subscriber_id", "profile_id",
            "customer_email", "amount_cents", "currency", F.lit("completed").alias("status"), F.col("received_at").alias("created_at")),
        "items": sold.where("product_id is not null").select(
            F.col("id").alias("purchase_id"), "product_id", F.lit(1).cast("long").alias("quantity"), F.col("amount_cents").alias("unit_price_cents"),
            F.lit(True).alias("access_granted"), F.col("received_at").alias("access_granted_at"), F.col("file").alias("download_url")),
        "people": names,
        "tags": person.where("product_type is not null").select("subscriber_id", slug.alias("tag")).distinct(),
        "amounts": person.groupBy("subscriber_id").agg(F.sum("amount_cents").alias("amount_cents")),
    }


@dataclass
class Books:
    """Tables before any booking: subscribers (id, email, full_name, source, status, has_purchased, ltv_cents, updated_at), profiles
    (id, email, full_name, stripe_customer_id, updated_at), tags (subscriber_id, tag); ids as strings."""
    subscribers: DataFrame
    profiles: DataFrame
    tags: DataFrame

    def after(self, added: dict[str, DataFrame]) -> Books:
        """The tables with additions applied; people of several additions are one per address."""
        met = added["people"].groupBy("email").agg(
            F.min("subscriber_id").alias("subscriber_id"), F.min("profile_id").alias("profile_id"),
            F.min_by("full_name", "created_at").alias("full_name"), F.max_by("stripe_customer_id", "updated_at").alias("_customer"),
            F.max("updated_at").alias("_seen"))
        sums = added["amounts"].groupBy(F.col("subscriber_id").alias("id")).agg(F.sum("amount_cents").alias("_added"))
        bought = met.select(F.col("subscriber_id").alias("id"), "email", "full_name", "_seen")
        subs = self._with_new(self.subscribers, bought, {"source": F.lit("purchase"), "status": F.lit("active"), "ltv_cents": F.lit(0).cast("long")})
        subs = subs.join(apart(sums), "id", "left").withColumns({
            "has_purchased": F.coalesce("has_purchased", F.lit(False)) | F.col("_seen").isNotNull(),
            "ltv_cents": F.coalesce("ltv_cents", F.lit(0)) + F.coalesce("_added", F.lit(0)),
            "updated_at": F.coalesce("_seen", "updated_at")}).select(*self.subscribers.columns)
        owners = met.select(F.col("profile_id").alias("id"), "email", "full_name", "_seen", "_customer")
        profs = self._with_new(self.profiles, owners, {}).withColumns({
            "stripe_customer_id": F.coalesce("_customer", "stripe_customer_id"), "updated_at": F.coalesce("_seen", "updated_at")})
        tags = self.tags.unionByName(added["tags"]).distinct()
        return Books(subs, profs.select(*self.profiles.columns), tags)

    @staticmethod
    def _with_new(table: DataFrame, met: DataFrame, fixed: dict[str, Column]) -> DataFrame:
        """The table's rows and those met for the first time, with what the meeting says beside them."""
        extra = [c for c in met.columns if c.startswith("_")]
        there = table.join(apart(met.select("id", *extra)), "id", "left")
        new = met.join(apart(table.select("id")), "id", "left_anti").withColumns({n: c.cast(table.schema[n].dataType) for n, c in fixed.items()})
        return there.unionByName(new.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in table.columns if c not in new.columns}))


def book_messages(messages: DataFrame, products: DataFrame, books: Books, ledger: DataFrame | None = None) -> tuple[dict[str, DataFrame], Books]:
    """Book a table of messages: what it adds, and the tables after it."""
    added = book(fresh(checkouts(messages), ledger), products, books.subscribers, books.profiles)
    return added, books.after(added)
