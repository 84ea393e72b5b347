"""Contacts, addresses and web sign-ups: reports, picks and promotion between address types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterbook.functions.rules import EMPTY_DATE, same_code
from meterbook.operators.ids import assign_ids, highest_id
from meterbook.operators.joins import earliest, join_keyed, newest
from meterbook.sources.schemas import SOURCE_TABLES
from meterbook.sources.tables import append_rows

PHONE = ["account", "phone_type"]

# The address columns that a promotion or update carries, by their source names.
ADDRESS_COLUMNS = """
    C_CUSTOMER C_ACCOUNT C_ADDTYPE C_ADDRESS1 C_ADDRESS2 C_POBOX C_STREETNUM C_STREET C_APT C_TOWN C_PROV
    C_POSTCODE C_PLAN C_LOT C_CONCESS C_LASTNAME C_FIRSTNAME C_MIDDLENAME C_SUFFIX C_PREFIX C_NAMETYPE C_EMAIL
    C_URL C_COUNTRY C_DELIVERYPOINT C_DRIVENUMPROV C_RELATIONSHIP L_VALIDATED C_STRNUMSUFFIX L_SENDBILL
    L_SENDNOTICE L_FAOVERRIDE L_MFOVERRIDE L_MAOVERRIDE D_STARTDATE D_ENDDATE L_SEASONAL L_SAOVERRIDE
    C_STREETPREFIX C_STREETSUFFIX C_EXTERNALREFID I_COUNT T_DATETIME T_LASTEXTERNALUPDATE L_CUSTOM1
    T_ADDRESSVALIDATED N_STREETNUM C_VALIDATIONSOURCE N_POBOX C_DELIVERYINSTALLATIONTYPE
    C_DELIVERYINSTALLATIONNAME C_VALIDATIONRESULT C_STREETPOSTDIRECTION
""".split()


def _of_type(rows: DataFrame, code: str) -> DataFrame:
    return rows.filter(same_code(F.col("add_type"), code))


def phone_by_priority(contacts: DataFrame, phone_types: DataFrame, types: Sequence[str]) -> DataFrame:
    """Each customer's first non-blank phone in the given order of types.

    Only contacts without an address type count, and types the type table lacks are
    skipped. Within a type the lowest contact id is taken.
    """
    wanted = F.array(*[F.lit(t.strip()) for t in types])
    rows = _of_type(contacts, "").filter(
        (F.array_position(wanted, F.col("phone_type")) > 0) & (F.rtrim("phone_number") != "")
    )
    rows = join_keyed(rows, phone_types, ["phone_type"], "inner")
    order = [F.array_position(wanted, F.col("phone_type")).alias("p"), "contact_info_id"]
    fields = ["phone_number", "phone_type", F.col("description").alias("phone_desc")]
    return rows.groupBy("customer").agg(earliest(fields, order).alias("c")).select("customer", "c.*")


def phone_by_priority_v1(contacts: DataFrame, phone_types: DataFrame, types: Sequence[str]) -> DataFrame:
    """The older form: the first wanted type with any contact, whose number may be blank.

    Within a type the contact with the lowest id decides; only if its number or the type's description is NULL does
    the search go on to the next type. Numbers keep their last 20 characters, descriptions their first 15, trimmed.
    """
    wanted = F.array(*[F.lit(t.strip()) for t in types])
    place = F.array_position(wanted, F.col("phone_type"))
    rows = join_keyed(_of_type(contacts, "").filter(place > 0), phone_types, ["phone_type"], "inner")
    fields = [
        F.trim(F.right("phone_number", F.lit(20))).alias("phone_number"),
        F.trim(F.left("description", F.lit(15))).alias("phone_desc"),
    ]
    first = rows.groupBy("customer", "phone_type").agg(earliest(fields, ["contact_info_id"]).alias("c"))
    usable = first.filter("c.phone_number is not null and c.phone_desc is not null")
    picked = earliest(["c.phone_number", "phone_type", "c.phone_desc"], [place.alias("p")])
    return usable.groupBy("customer").agg(picked.alias("c")).select("customer", "c.*")


def contact_recency(contacts: DataFrame, old: str = "BF", new: str = "BM") -> DataFrame:
    """Is a contact of the old address type newer than its peers of the new type?

    One row per old contact, set against the newest peer of the same account and
    phone type; ``peers`` counts them, so nothing is multiplied out.
    """
    peers = _of_type(contacts, new).groupBy(*PHONE).agg(
        F.max("updated").alias("new_updated"), F.count(F.lit(1)).alias("peers")
    )
    rows = join_keyed(_of_type(contacts, old), peers, PHONE, "left")
    never = F.lit(EMPTY_DATE).cast("timestamp_ntz")
    newer = F.col("updated") > F.coalesce("new_updated", never)
    return rows.withColumn("peers", F.coalesce("peers", F.lit(0))).withColumn(
        "update_status",
        F.when(newer, f"{old} is newer - UPDATE NEEDED").otherwise(f"{new} is newer or equal - NO UPDATE NEEDED"),
    )


def without_peer(rows: DataFrame, key: Sequence[str], old: str = "BF", new: str = "BM") -> DataFrame:
    """Rows of the old address type whose key has no row of the new type."""
    peers = _of_type(rows, new).select(*key).distinct()
    return join_keyed(_of_type(rows, old), peers, key, "left_anti")


def _carried(addresses: DataFrame) -> list[str]:
    """The table's columns that are copied between address types; any other is a key of its own row."""
    known = {SOURCE_TABLES["BIF006"].get(c, c).upper() for c in ADDRESS_COLUMNS}
    return [c for c in addresses.columns if c.upper() in known]


def promote_addresses(addresses: DataFrame, old: str = "BF", new: str = "BM") -> tuple[DataFrame, DataFrame]:
    """Copy old-type addresses to the new type where an account has none, then drop the old type.

    Returns the new table and the deleted rows.
    """
    copies = without_peer(addresses, ["account"], old, new).withColumn("add_type", F.lit(new))
    copies = copies.select(_carried(addresses))
    kept = addresses.filter(~same_code(F.col("add_type"), old) | F.col("add_type").isNull())
    return append_rows(kept, copies), _of_type(addresses, old)


def contact_copies(contacts: DataFrame, old: str = "BF", new: str = "BM") -> DataFrame:
    """Old-type contacts without a peer, as new-type rows with new ids after the highest one."""
    source = without_peer(contacts, PHONE, old, new).withColumn("add_type", F.lit(new))
    carried = [c for c in contacts.columns if c != "contact_pk"]
    ordered = source.select(carried).withColumnRenamed("contact_info_id", "_old_id")
    numbered = assign_ids(
        ordered, [*PHONE, "_old_id"], highest_id(contacts, "contact_info_id"), "contact_info_id"
    )
    return numbered.drop("_old_id").select(carried)


def promote_contacts(contacts: DataFrame, old: str = "BF", new: str = "BM") -> tuple[DataFrame, DataFrame]:
    """Promote contacts as :func:`promote_addresses` does, per account and phone type."""
    kept = contacts.filter(~same_code(F.col("add_type"), old) | F.col("add_type").isNull())
    return append_rows(kept, contact_copies(contacts, old, new)), _of_type(contacts, old)


def sync_newer(
    rows: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str | Column],
    old: str = "BF",
    new: str = "BM",
) -> DataFrame:
    """Update new-type rows from the newest old-type row of the same key, where that is strictly newer.

    ``order`` decides which old row is the newest (``updated`` first, then a tie-break).
    """
    latest = (
        _of_type(rows, old)
        .groupBy(*key)
        .agg(newest([F.col(c).alias(f"_{c}") for c in columns], order).alias("_src"))
    )
    joined = join_keyed(rows, latest, key, "left")
    update = same_code(F.col("add_type"), new) & (F.col("_src._updated") > F.col("updated"))
    update = F.coalesce(update, F.lit(False))
    picked = [
        (F.when(update, F.col(f"_src._{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c))
        for c in rows.columns
    ]
    return joined.select(picked)


def sync_newer_contacts(contacts: DataFrame, old: str = "BF", new: str = "BM") -> DataFrame:
    # The columns the update copies.
    columns = ["phone_number", "updated", "custom1", "notes", "preferred", "contact_times"]
    return sync_newer(contacts, PHONE, columns, ["updated", "contact_info_id"], old, new)


def sync_newer_addresses(addresses: DataFrame, old: str = "BF", new: str = "BM") -> DataFrame:
    """The carried columns but the keys are copied; equal times are ordered by the copied columns."""
    columns = [c for c in _carried(addresses) if c not in ("customer", "account", "add_type")]
    order = ["updated", *[c for c in columns if c != "updated"]]
    return sync_newer(addresses, ["account"], columns, order, old, new)


def latest_web_contact(web_signups: DataFrame) -> DataFrame:
    """The sign-up with the greatest id of each customer; sign-ups without a customer drop out."""
    return (
        web_signups.filter(F.col("customer").isNotNull())
        .groupBy("customer")
        .agg(F.max("web_pk").alias("web_pk"), F.max_by("email", "web_pk").alias("email"))
    )


def web_contacts_insert(
    web_signups: DataFrame, contacts: DataFrame, updated, phone_type: str = "E3", drop_null: bool = False
) -> DataFrame:
    """New e-mail contacts from the latest sign-ups, with ids after the highest contact id.

    A sign-up already present is skipped. A NULL e-mail equals nothing, so it is
    inserted unless ``drop_null`` is set.
    """
    present = (
        contacts.filter(same_code(F.col("phone_type"), phone_type))
        .select("customer", F.col("phone_number").alias("email"))
        .distinct()
    )
    rows = join_keyed(latest_web_contact(web_signups), present, ["customer", "email"], "left_anti")
    if drop_null:
        rows = rows.filter(F.col("email").isNotNull())
    numbered = assign_ids(rows, ["web_pk"], highest_id(contacts, "contact_pk"), "contact_pk")
    return numbered.select(
        "customer",
        F.lit(phone_type).alias("phone_type"),
        F.col("email").alias("phone_number"),
        F.lit(str(updated)).cast("timestamp_ntz").alias("updated"),
        "contact_pk",
        F.col("contact_pk").alias("contact_info_id"),
    )


def web_contacts_table(
    web_signups: DataFrame, contacts: DataFrame, updated, phone_type: str = "E3", drop_null: bool = False
) -> DataFrame:
    """The contact table after the sign-up job: new rows added, and every row of the type takes its key as its id."""
    new = web_contacts_insert(web_signups, contacts, updated, phone_type, drop_null)
    keyed = F.when(same_code(F.col("phone_type"), phone_type), F.col("contact_pk")).otherwise(F.col("contact_info_id"))
    return append_rows(contacts, new).withColumn("contact_info_id", keyed)
