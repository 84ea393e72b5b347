"""Billing-shaped tables derived from the driver's order tables.

Each text is a plain SELECT that Spark and DuckDB read alike; ``{name}`` stands
for another table. They are inputs for the registered queries and the checks, not
part of the operators.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterbook.session import materialize
from meterbook.sources.seeds import CARD_TYPES, CROSSWALK
from meterbook.sources.tables import canonical_codes, load

AS_OF = "2001-07-15"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def _values(columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as v({columns})"


DERIVED: dict[str, str] = {
    # ---- accounts, customers, addresses ------------------------------------------------
    "accounts": """
        select cast(c_custkey as bigint) as customer, cast(c_custkey + 700000 as bigint) as account,
               substr(c_mktsegment, 1, 2) as account_type,
               '0' || cast(c_nationkey % 3 as varchar(2)) as division, '1' as company,
               case when c_nationkey % 5 = 0 then 'FI' else 'AC' end as account_status,
               case c_nationkey % 4 when 0 then 'PD' when 1 then 'DC' else '' end as col_status,
               'BG' || cast(c_custkey % 8 as varchar(4)) as bill_group,
               c_custkey % 50 = 0 as is_master,
               cast(c_custkey % 12 as varchar(4)) as cycle,
               cast(1000 + c_custkey % 9000 as varchar(10)) as pin,
               date '1994-06-01' + cast(c_custkey % 1000 as int) as effective_date
        from {customer}
        union all
        select cast(c_custkey as bigint) as customer, cast(c_custkey + 700000 as bigint) as account,
               substr(c_mktsegment, 1, 2), '0' || cast(c_nationkey % 3 as varchar(2)), '1', 'FI', '',
               'BG' || cast((c_custkey + 4) % 8 as varchar(4)), c_custkey % 100 = 0,
               'X' || cast(c_custkey % 12 as varchar(4)), '0',
               date '1993-01-01' + cast(c_custkey % 1000 as int)
        from {customer} where c_custkey % 4 = 1 or c_custkey % 100 = 0
        union all
        select cast(c_custkey + 1 as bigint), cast(c_custkey + 700000 as bigint),
               substr(c_mktsegment, 1, 2), '02', '1', 'AC', 'PD', 'BG' || cast(c_custkey % 8 as varchar(4)), false,
               cast(c_custkey % 12 as varchar(4)), '7', date '1995-01-01' + cast(c_custkey % 1000 as int)
        from {customer} where c_custkey % 30 = 7""",
    "customers": """
        select cast(c_custkey as bigint) as customer, substr(c_name, 1, 8) as first_name, c_name as last_name
        from {customer}""",
    "service_addresses": """
        select cast(c_custkey + 700000 as bigint) as account,
               case when c_custkey % 23 = 0 then null else cast(c_custkey % 9000 + 1 as int) end as street_num,
               case when c_custkey % 29 <> 0 then cast(c_custkey % 9000 + 1 as varchar(10))
                    || case when c_custkey % 5 = 0 then 'A' else '' end end as street_num_text,
               'S' || cast(c_custkey % 4 as varchar(2)) as num_suffix,
               'N' || cast(c_nationkey as varchar(4)) as street_prefix,
               c_mktsegment as street,
               case when c_custkey % 19 = 0 then null else 'ST' end as street_suffix,
               case when c_custkey % 3 = 0 then '' else 'A' || cast(c_custkey % 90 as varchar(4)) end as apt,
               'Town' || cast(c_nationkey as varchar(4)) as town, 'PR' as prov,
               cast(10000 + c_custkey % 80000 as varchar(10)) as post_code
        from {customer}""",
    "street_prefixes": """
        select 'N' || cast(n_nationkey as varchar(4)) as street_prefix, n_name as description
        from {nation} where n_nationkey < 20""",
    "num_suffixes": _values("code, description", [("S0", "1/2"), ("S1", "A"), ("S2", "REAR")]),
    "addresses": """
        select user_id as customer, user_id + 700000 as account,
               case when event_type = 'click' then 'BF'
                    when event_type = 'purchase' and user_id % 3 <> 0 then 'BM' else '' end as add_type,
               'L' || cast(event_id as varchar(12)) as address1,
               case when event_id % 4 = 0 then null else 'u' || cast(event_id as varchar(12)) || '@x.test' end as email,
               event_id % 2 = 0 as send_bill, ts as updated
        from {events}""",
    "contacts": """
        select event_id as contact_info_id, event_id as contact_pk, user_id as customer, user_id + 700000 as account,
               'P' || cast(cast(floor(value) as bigint) % 30 as varchar(4)) as phone_type,
               case when event_id % 11 = 0 then '' when event_id % 13 = 0 then null
                    else cast(event_id * 7919 % 10000000 as varchar(12)) end as phone_number,
               case event_type when 'click' then 'BF' when 'purchase' then 'BM' else '' end as add_type,
               ts as updated, event_id % 5 = 0 as custom1,
               case when event_id % 6 = 0 then 'note ' || cast(event_id as varchar(12)) end as notes,
               event_id % 7 = 0 as preferred, 'ANY' as contact_times
        from {events}""",
    "phone_types": """
        select distinct 'P' || cast(cast(floor(value) as bigint) % 30 as varchar(4)) as phone_type,
               'Type ' || cast(cast(floor(value) as bigint) % 30 as varchar(4)) as description
        from {events} where cast(floor(value) as bigint) % 30 <> 7""",
    "web_signups": """
        select event_id as web_pk,
               case when event_id % 37 = 0 then cast(null as bigint) else user_id end as customer,
               case when user_id % 17 = 0 then null
                    else 'u' || cast(user_id as varchar(12)) || '.' || cast(event_id % 3 as varchar(2)) || '@x.test'
               end as email
        from {events} where event_type = 'signup'""",
    "web_contacts": """
        select contact_info_id, contact_pk, customer, account, phone_type, phone_number, add_type, updated,
               custom1, notes, preferred, contact_times
        from {contacts}
        union all
        select event_id + 2000000000 as contact_info_id, event_id + 1000000000 as contact_pk,
               user_id as customer, user_id + 700000 as account, 'E3',
               'u' || cast(user_id as varchar(12)) || '.0@x.test', '', ts, false, null, false, ''
        from {events} where event_type = 'signup' and event_id % 5 = 0""",
    # ---- services and multipliers ------------------------------------------------------
    "services": """
        select o_custkey + 700000 as account, case o_orderkey % 3 when 0 then '30' when 1 then '10' else 'W' end as service,
               cast(o_orderkey - o_orderkey % 2 as bigint) as servgrp_id,
               cast(o_orderkey as bigint) as service_id,
               case o_orderkey % 3 when 0 then '30' when 1 then '10' else 'W' end as service_group,
               cast(o_orderdate as date) as install_date
        from {orders}""",
    "multipliers": """
        select cast(o_orderkey + 1 as bigint) as multiplier_pk, cast(o_orderkey as bigint) as servgrp_id,
               cast(1 + o_orderkey % 2 as int) as multiplier,
               cast(cast(4 as int) as decimal(15,2)) as basic_multiple, '' as notes,
               cast(o_orderdate as date) as start_date, date '1900-01-01' as end_date,
               case o_orderkey % 3 when 0 then '30' when 1 then '10' else 'W' end as service_group
        from {orders} where o_orderkey % 5 = 0""",
    # ---- bills and lines ---------------------------------------------------------------
    "bills": """
        select o_orderkey + 1 as bill_number, o_custkey as customer, o_custkey + 700000 as account,
               cast(o_orderdate as date) as bill_date, cast(o_orderdate as date) + 21 as due_date,
               case when o_orderkey % 10 = 0 then cast(o_orderdate as date) + 35 end as new_due_date,
               o_orderdate as calc_ts,
               cast(o_totalprice as decimal(15,2)) as current_amount,
               cast(cast(o_totalprice as decimal(15,2)) - 25.00 as decimal(15,2)) as amount_due_before,
               cast(cast(o_totalprice as decimal(15,2)) - 100.00 as decimal(15,2)) as balance_forward,
               cast(cast(o_orderkey % 7 as int) as decimal(15,2)) as cancelled_billing,
               cast(cast(o_orderkey % 11 as int) as decimal(15,2)) as since_last_bill,
               cast(case when o_orderkey % 41 = 0 then null else cast(o_orderkey % 13 as int) end as decimal(15,2))
                   as previous_billing,
               cast(cast(o_totalprice as decimal(15,2)) + 60000.00 as decimal(15,2)) as plan_bill,
               cast(cast(-(o_orderkey % 90) as int) as decimal(15,2)) as plan_cred,
               case when o_orderkey % 9 = 0 then null else o_orderkey % 2 = 0 end as is_reconcile,
               case when o_orderpriority = '1-URGENT' then 'CB' when o_orderpriority = '5-LOW' then 'FN' else 'RG' end
                   as bill_type,
               case when o_orderkey % 7 = 0 then 'LN' else 'EN' end as plan_type,
               case cast(o_custkey % 5 as int) when 0 then 'AU' when 1 then 'BU' when 2 then 'FU' when 3 then 'HO'
                   else '' end as account_type,
               'BG' || cast(o_custkey % 8 as varchar(4)) as bill_group,
               o_custkey % 50 = 0 as is_master,
               o_orderkey % 17 = 0 as is_cancelled, o_orderkey % 23 = 0 as no_bill,
               o_orderstatus <> 'P' as processed,
               case when o_orderpriority = '1-URGENT' then o_orderkey else 0 end as orig_bill,
               cast(o_orderkey % 100 as bigint) as batch_id, 'U' || cast(o_orderkey % 5 as varchar(4)) as user_id
        from {orders}""",
    "bill_txns": """
        select l_orderkey + 1 as bill_number, (l_orderkey + 1) * 10 + l_linenumber as trans_num,
               substr('AFAONFNORFRO', 1 + 2 * max(case l_returnflag when 'A' then 0 when 'N' then 2 else 4 end
                                                + case l_linestatus when 'F' then 0 else 1 end), 2) as trans_code,
               cast(sum(cast(l_extendedprice as decimal(15,2))) as decimal(15,2)) as amount, count(*) as n
        from {lineitem} group by l_orderkey, l_linenumber""",
    "bill_lines": """
        select t.bill_number, o.o_custkey + 700000 as account, t.trans_num, t.trans_code, t.amount,
               cast(o.o_orderdate as date) as trans_date,
               t.trans_num % 4 <> 1 as in_balance,
               cast(case when t.trans_num % 9 = 0 then 5 when t.trans_num % 2 = 0 then 0 else 1 end as int) as sum_flag,
               'AR' || cast(t.trans_num % 4 as varchar(2)) as ar_code,
               case when t.trans_num % 13 = 0 then t.bill_number else 0 end as orig_bill
        from {bill_txns} t join {orders} o on t.bill_number = o.o_orderkey + 1
        where t.trans_num % 7 <> 3""",
    "ar_txns": """
        select t.trans_num, o.o_custkey as customer, o.o_custkey + 700000 as account,
               case when t.trans_num % 4 = 0 then 0 else t.bill_number end as bill_number, t.trans_code,
               cast(case when t.trans_num % 3 = 0 then -t.amount else t.amount end as decimal(15,2)) as amount,
               cast(o.o_orderdate as date) + cast(t.trans_num % 60 as int) as trans_date,
               t.trans_num % 5 = 0 as is_statement,
               case when t.trans_num % 6 = 0 then cast(o.o_orderdate as date) + 30 end as aging_date,
               case when t.trans_num % 8 = 0 then t.trans_num else 0 end as linked_trans_num
        from {bill_txns} t join {orders} o on t.bill_number = o.o_orderkey + 1""",
    "ar_balances": """
        select o_custkey as customer, o_custkey + 700000 as account, 'AR' || cast(o_orderkey % 4 as varchar(2)) as ar_code,
               cast(sum(case when o_orderkey % 5 = 0 then -cast(o_totalprice as decimal(15,2))
                             else cast(o_totalprice as decimal(15,2)) end) as decimal(15,2)) as current_balance
        from {orders} group by o_custkey, 'AR' || cast(o_orderkey % 4 as varchar(2))""",
    "service_orders": """
        select o_custkey as customer, o_custkey + 700000 as account, o_orderkey % 2 = 0 as is_cancelled,
               o_orderstatus = 'F' as is_completed
        from {orders} where o_orderkey % 9 = 0""",
    # ---- payments ----------------------------------------------------------------------
    "payments": """
        select o_orderkey + 1 as trans_num, o_custkey as customer, o_custkey + 700000 as account,
               cast(-o_totalprice as decimal(15,2)) as amount,
               case when o_orderkey % 40 = 0 then -1
                    else cast(o_custkey % 3 as int) + cast(year(o_orderdate) as int) end as batch_id,
               cast(o_orderdate as date) + 14 as pay_date,
               case when o_orderkey % 5 = 0 then o_orderkey % 3 else 0 end as parent_tr,
               case when o_orderkey % 4 = 0 then o_orderkey else 0 end as receipt,
               case when o_orderkey % 2 = 0 then cast(floor((o_orderkey + 1) / 10) as bigint) else 0 end as paid_bill,
               case when o_orderkey % 31 = 0 then '' else 'AR1' end as ar_code,
               case when o_orderpriority = '5-LOW' then 'DEP1' when o_orderpriority = '4-NOT SPECIFIED' then 'PAYM'
                    else 'PAY1' end as trans_code,
               o_orderstatus = 'F' as processed, o_orderkey % 29 = 0 as is_deleted
        from {orders}""",
    "batches": """
        select distinct batch_id, case when batch_id % 5 = 0 then 'AD' else 'CA' end as transaction_type
        from {payments}""",
    "ext_pending": """
        select event_id as ext_id, user_id as customer, user_id + 700000 as account,
               cast(-cast(value as decimal(15,2)) as decimal(15,2)) as amount, event_id % 2 = 0 as processed
        from {events} where event_type = 'purchase'""",
    # ---- plans, arrangements, comments -------------------------------------------------
    "plan_enrolments": """
        select cast(c_custkey as bigint) as customer, cast(c_custkey + 700000 as bigint) as account,
               case c_custkey % 7 when 0 then 'EN' when 1 then 'E2' when 2 then 'LN' when 3 then 'L2'
                    when 4 then 'VA' when 5 then 'V2' else 'ZZ' end as plan_type,
               date '1999-01-01' + cast(c_custkey % 900 as int) as start_date,
               case when c_custkey % 5 = 0 then date '2000-06-30' + cast(c_custkey % 700 as int) end as stop_date
        from {customer} where c_custkey % 10 < 5
        union all
        select cast(c_custkey as bigint) as customer, cast(c_custkey + 700000 as bigint) as account,
               case c_custkey % 3 when 0 then 'LN' when 1 then 'EN' else 'VA' end,
               date '1999-06-01' + cast(c_custkey % 500 as int), cast(null as date)
        from {customer} where c_custkey % 20 < 3""",
    "plan_types": _values(
        "plan_type, plan_class, draw, use_plan_balance, use_plan_billed, exclude_credits, exclude_debits",
        [
            ("EN", "E", True, True, True, "RF", "NF"),
            ("E2", "E", False, False, True, "", ""),
            ("LN", "L", False, True, False, "AO", ""),
            ("L2", "L", True, False, True, None, ""),
            ("VA", "V", True, True, True, "", ""),
            ("V2", "V", False, None, False, "X", ""),
            ("ZZ", "Z", True, False, True, "", ""),
        ],
    ),
    "plan_balances": """
        select cast(c_custkey as bigint) as customer, cast(c_custkey + 700000 as bigint) as account,
               cast(cast(c_acctbal as decimal(15,2)) + 500.00 as decimal(15,2)) as plan_billed,
               cast(-50.00 as decimal(15,2)) as credits
        from {customer} where c_custkey % 9 <> 0""",
    "arrangements": """
        select o_custkey as customer, o_custkey + 700000 as account, cast(o_totalprice as decimal(15,2)) as amount,
               cast(o_orderdate as date) + 30 as arrange_date,
               substr('NBKPX', cast(o_orderkey % 5 as int) + 1, 1) as status,
               case when o_orderkey % 2 = 0 then cast(o_custkey % 4 as int) else 0 end as group_id
        from {orders} where o_orderkey % 6 = 0""",
    "comments": """
        select event_id as comment_id, user_id as customer, user_id + 700000 as account,
               'C' || cast(event_id % 7 as varchar(4)) as comment_code,
               case when event_id % 3 = 0 then date '2001-07-01'
                    when event_id % 3 = 1 and user_id % 2 = 0 then cast(null as date)
                    else date '2001-05-01' + cast(event_id % 90 as int) end as expiration_date
        from {events} where event_type = 'error'""",
    # ---- code tables -------------------------------------------------------------------
    "trans_codes": _values(
        "trans_code, transaction_type, include_in_owing, is_nsf, use_original_age",
        [
            ("AF", "AD", False, False, False),
            ("AO", "AD", False, True, False),
            ("NF", "CA", False, False, False),
            ("NO", "CA", False, False, True),
            ("RF", "CH", True, False, False),
            ("RO", "CH", False, False, True),
            ("PAY1", "CA", False, False, False),
            ("PAYM", "CA", False, False, False),
            ("DEP1", "DE", False, False, False),
        ],
    ),
    "plain_trans_codes": """
        select trans_code, transaction_type, false as include_in_owing, is_nsf, use_original_age from {trans_codes}""",
    "ar_codes": _values(
        "ar_code, in_balance, is_summary, deposit_paid, deposit_interest, credit_code, debit_code",
        [
            ("AR0", True, True, False, False, "CR0", "DB0"),
            ("AR1", True, False, False, False, "RO", ""),
            ("AR2", False, True, True, False, "CR0", "DB2"),
            ("AR3", False, False, False, False, "CR3", "DB3"),
        ],
    ),
    "deposit_codes": _values("deposit_code", [("DEP1",), ("DEP9",)]),
    "bill_groups": _values(
        "bill_group, updates_master", [(f"BG{i}", i % 4 == 0) for i in range(8)]
    ),
    "grace_days": _values(
        "account_type, bill_type, days",
        [("AU", "RG", 5), ("AU", "RG", 2), ("BU", "RG", 10), ("BU", "FN", 3), ("FU", "FN", 20), ("HO", "RG", 15)],
    ),
    "comment_codes": _values(
        "comment_code, cash_only, comment_type, disallowed",
        [
            ("C0", True, "A", "CC,"),
            ("C1", True, "C", ""),
            ("C2", False, "A", "CC,DD"),
            ("C3", False, "C", "CHK"),
            ("C4", False, "A", ""),
            ("C5", False, "A", None),
        ],
    ),
    "payment_types": _values(
        "code, payment_type, container",
        [
            ("AP", "APPLE", "appleBox"),
            ("C", "CASH", "cashBox"),
            ("CC", "CREDIT", "creditBox"),
            ("CHK", "CHECK", "checkBox"),
            ("DD", "DEBIT", "debitBox"),
            ("XX", "", "spareBox"),
        ],
    ),
    "collection_settings": _values("pending_status, disconnect_status", [("", ""), ("PD", ""), ("", "DC")]),
    "company_settings": _values("pending_in_past_due", [(True,)]),
    # ---- literal seeds spread over the events --------------------------------------------
    "crosswalk": _values("integ_key, external_value, internal_code", CROSSWALK),
    "external_codes": """
        select event_id,
               cast(case when event_id % 3 = 0 then 250 + event_id % 20 else 440 + event_id % 45 end as varchar(8))
                   as external_value
        from {events}""",
    "card_seed": _values(
        "seed_no, pay003_fk, card_type, description, transaction_code, external_source",
        [(i, *row) for i, row in enumerate(CARD_TYPES)],
    ),
    "card_types": """
        select cast(e.user_id as bigint) as pay003_fk,
               case when e.event_id % 10 = 0 and s.card_type = 'e-check/ACH' then 'eCheck'
                    when e.event_id % 10 = 1 and s.card_type = 'PayPal credit' then 'PayPal'
                    when e.event_id % 10 = 2 and s.card_type = 'Google_PAY' then 'GooglePay'
                    when e.event_id % 10 = 3 and s.card_type = 'Amazon Pay' then 'WalmartPay'
                    when e.event_id % 10 = 4 and s.card_type = 'VENMO' then 'Venmo'
                    when e.event_id % 10 = 5 and s.card_type = 'Apple Pay' then 'ApplePay'
                    else s.card_type end as card_type,
               s.description, s.transaction_code, s.external_source
        from {events} e join {card_seed} s on s.seed_no = e.event_id % 128""",
    "lookup_requests": """
        select event_id as request_id, user_id * (1 + event_id % 3) as customer,
               case when event_id % 5 = 0 then user_id + 1 else user_id * (1 + event_id % 3) end + 700000 as account,
               case when event_id % 11 = 0 then '2000-13-45' when event_id % 17 = 0 then '' when event_id % 7 = 0 then '19990101'
                    when event_id % 7 = 1 then ' 1/1/1999 ' when event_id % 7 = 2 then '01-01-1999' when event_id % 7 = 3 then 'Jan 1, 1999'
                    else '1999-01-01' end as first_text,
               case event_id % 13 when 0 then 'soon' when 1 then null when 2 then '12.31.2000' when 3 then '31 Dec 2000'
                    when 4 then '2000/12/31' when 5 then '12/32/2000' when 6 then '2000-12-31 23:59:59' else '2000-12-31' end
                   as last_text
        from {events}""",
}


#: Code columns that the tables hold with blanks behind them and in either case, as a source with such a collation may.
#: The SQL counterparts read the plain codes: what the source holds equal must come out equal.
#: By table: the number that decides how a row's codes are written, and the columns.
PADDED = {
    "accounts": ("customer", ["account_type", "bill_group"]),
    "addresses": ("customer", ["add_type"]),
    "ar_balances": ("customer", ["ar_code"]),
    "ar_txns": ("trans_num", ["trans_code"]),
    "bill_lines": ("trans_num", ["trans_code", "ar_code"]),
    "bills": ("bill_number", ["account_type", "bill_type", "bill_group"]),
    "comments": ("comment_id", ["comment_code"]),
    "contacts": ("contact_pk", ["add_type", "phone_type"]),
    "payments": ("trans_num", ["trans_code"]),
    "plan_enrolments": ("customer", ["plan_type"]),
    "services": ("service_id", ["service"]),
}


def padded(df: DataFrame, number: str, columns: list[str]) -> DataFrame:
    """Codes with none, one or two blanks behind them, every fifth in lower case."""
    kind = F.col(number)

    def written(name: str):
        text = F.when(kind % 5 == 0, F.lower(name)).otherwise(F.col(name))
        return F.concat(text, F.when(kind % 3 == 0, "").when(kind % 3 == 1, " ").otherwise("  "))

    return df.withColumns({name: written(name) for name in columns})


def names_in(text: str) -> list[str]:
    """The tables a text refers to, in order of appearance."""
    seen: dict[str, None] = {}
    for _, field, _, _ in string.Formatter().parse(text):
        if field:
            seen.setdefault(field)
    return list(seen)


class Tables:
    """Tables of one folder by attribute, each built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DERIVED and name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._built:
            if name in DERIVED:
                text = DERIVED[name]
                parts = {n: getattr(self, n) for n in names_in(text)}
                built = self.spark.sql(text, **parts)
                if name in PADDED:
                    built = canonical_codes(padded(built, *PADDED[name]))
                self._built[name] = built
            else:
                self._built[name] = load(self.spark, self.folder, name)
        return self._built[name]

    def stored(self, *names: str) -> Tables:
        """Write derived tables once, as the tables they stand for are stored.

        For plans that read them in several steps.
        """
        for name in names:
            self._built[name] = materialize(getattr(self, name))
        return self


def as_ctes(name: str, extra: dict[str, str]) -> list[tuple[str, str]]:
    """Texts needed for ``name`` as (name, text) pairs in dependency order."""
    texts = {**DERIVED, **extra}
    done: dict[str, str] = {}

    def visit(current: str) -> None:
        if current in done or current not in texts:
            return
        for other in names_in(texts[current]):
            visit(other)
        done[current] = texts[current].format(**{n: n for n in names_in(texts[current])})

    visit(name)
    return list(done.items())
