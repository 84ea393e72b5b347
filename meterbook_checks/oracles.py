"""SQL for DuckDB that states each registered query in the plainest relational form.

Texts refer to the derived tables as ``{name}`` and to each other as ``{q_name}``;
``@asof``, ``@real`` and ``@settled`` stand for the day and the two common filters.
They use windows and correlated subqueries on purpose, unlike the Spark operators.
"""

from __future__ import annotations

from meterbook.sources.derived import AS_OF, as_ctes

_MARKS = {
    "@asof": f"date '{AS_OF}'",
    "@real": "(not is_cancelled and not no_bill and bill_type <> 'CB' and processed)",
    "@settled": "(amount < 0 and processed and not is_deleted)",
}

_TARGETS = "(select account from {accounts} where account_type = 'BU' and division = '02')"
_NUM_TARGET = """try_cast(a.company as int) = 1 and try_cast(a.division as int) = 2
    and a.account_type = 'BU' and try_cast(b.service as int) = 30"""


def _last_payment(extra: str) -> str:
    return (
        """
    with eligible as (
        select p.*, row_number() over w as rn, first_value(batch_id) over w as first_batch,
               first_value(pay_date) over w as first_date
        from {payments} p
        where @settled and ar_code <> ''
          and batch_id in (select batch_id from {batches} where transaction_type = 'CA')
          """
        + extra
        + """
        window w as (partition by customer, account order by pay_date desc, trans_num desc)
    ), marked as (
        select e.*, sum(case when batch_id <> first_batch then 1 else 0 end)
                    over (partition by customer, account order by rn) as breaks
        from eligible e
    ), run as (
        select customer, account, min(first_batch) as first_batch, min(first_date) as first_date,
               sum(case when breaks = 0 then amount end) as run_amount
        from marked group by customer, account
    )
    select r.customer, r.account,
           cast(case when first_batch = -1
                then (select sum(p.amount) from {payments} p where @settled and p.customer = r.customer
                      and p.account = r.account and p.pay_date = r.first_date)
                else run_amount end as decimal(15,2)) as payment_amount,
           first_date as payment_date
    from run r"""
    )


def _unbilled(notice: bool) -> str:
    join = "join {trans_codes} g on g.trans_code = a.trans_code and not g.include_in_owing" if notice else ""
    return f"""
    select a.customer, a.account, cast(sum(a.amount) as decimal(15,2)) as unbilled_amount
    from {{ar_txns}} a {join} join {{q_exclude_codes}} x on x.customer = a.customer and x.account = a.account
    where a.trans_date > @asof - interval 12 month and not a.is_statement and a.amount > 0
      and a.aging_date is null
      and ((a.bill_number = 0 and (a.linked_trans_num = 0
                 or (select count(*) from {{bill_lines}} l where l.trans_num = a.trans_num) = 0))
           or (coalesce((select max(p.paid_bill) from {{payments}} p where p.trans_num = a.trans_num), 0) = a.bill_number
               and coalesce((select max(b.due_date) from {{bills}} b where b.bill_number = a.bill_number), @asof)
                   < @asof))
      and instr(x.exclude_codes, a.trans_code || ',') = 0
    group by a.customer, a.account"""


def _past_due(notice: bool) -> str:
    not_due = "{q_not_due_amount}" if notice else "{q_not_due_bills}"
    unbilled = "{q_unbilled_amount}" if notice else "{q_unbilled_amount_plain}"
    return f"""
    with base as (
        select a.customer, a.account, c.current_balance, m.master_not_due, p.use_plan_billed, pp.plan_past_due,
               coalesce(n.not_due_amount, 0) as not_due, coalesce(u.unbilled_amount, 0) as unbilled,
               coalesce(w.pending_payment, 0) as pending, coalesce(f.nsf_amount, 0) as nsf, o.due_date as overdue
        from {{q_current_accounts}} a
        join {{q_current_balance}} c using (customer, account)
        left join {{q_master_not_due}} m using (customer, account)
        left join {{q_plan_status}} p using (customer, account)
        left join {{q_plan_past_due}} pp using (customer, account)
        left join {not_due} n using (customer, account)
        left join {unbilled} u using (customer, account)
        left join {{q_pending_payments}} w using (customer, account)
        left join {{q_nsf_amount}} f using (customer, account)
        left join {{q_last_past_due_bill}} o using (customer, account)
    ), raw as (
        select *, case
            when master_not_due is not null
                then current_balance - case when master_not_due > 0 then master_not_due else 0 end
            else case when use_plan_billed then plan_past_due
                      when current_balance > 0 then current_balance - abs(not_due)
                      else current_balance end
                 - unbilled + pending - nsf end as owed
        from base
    )
    select customer, account, current_balance,
           cast(case when owed < 0 then 0 else owed end as decimal(15,2)) as past_due_amount,
           case when owed < 0 then date '1900-01-01' else coalesce(overdue, date '1900-01-01') end as past_due_date
    from raw"""


_RECODE = """case card_type when 'Visa' then 'VISA' when 'MasterCard' then 'MC' when 'AmericanExpress' then 'AMEX'
    when 'Discover' then 'DISC' when 'eCheck' then 'CHQ' when 'PayPal' then 'PAYPAL'
    when 'WalmartPay' then 'WALMART_PAY' when 'Venmo' then 'VENMO' when 'GooglePay' then 'GP'
    when 'ApplePay' then 'AP' else card_type end"""


def _expansions() -> str:
    pairs = [
        ("VISA", "VISA_DEBIT"),
        ("MC", "MC_DEBIT"),
        ("DISC", "DISC_DEBIT"),
        ("CHQ", "SAV"),
        ("PAYPAL", "PAYPAL_CREDIT"),
        ("PAYPAL", "PAYPAL_ACCOUNT"),
    ]
    return " union all ".join(
        f"select distinct pay003_fk, '{new}' as card_type, description, transaction_code, external_source "
        f"from {{q_card_type_recode}} where card_type = '{old}'"
        for old, new in pairs
    )


def _pos() -> str:
    codes = ["AMEX", "DISC", "DISC_DEBIT", "MC", "MC_DEBIT", "VISA", "VISA_DEBIT"]
    return " union all ".join(
        f"select * from (select distinct pay003_fk, 'CP_POS_{c}' as card_type, description, transaction_code, "
        f"external_source from {{q_expanded}} where card_type = '{c}' and transaction_code = 'DEP2' "
        "order by pay003_fk, description, transaction_code, external_source limit 1)"
        for c in codes
    )


_SUMMARY_TAIL = """
        left join {q_last_payment%(pay)s} lp using (customer, account)
        left join {q_arrangement_status} ar using (customer, account)
        left join {q_cash_only} co using (customer, account)
        left join {q_comment_restrictions%(v)s} cr using (customer, account)
        left join {q_formatted_service_address%(v)s} sa using (account)
        left join {customers} cu using (customer)
        left join {q_phone_by_priority%(v)s} ph using (customer)"""

ORACLES: dict[str, str] = {
    "code_crosswalk": """
    select e.*, (select min(internal_code) from {crosswalk} x
                 where x.integ_key = 25 and x.external_value = e.external_value) as internal_code
    from {external_codes} e""",
    "card_type_seed": """
    select * from {card_types}
    union all select pay003_fk, card_type, description, transaction_code, external_source from {card_seed}""",
    "snapshot_if_absent": "select count(*) as snapshot_rows from {bill_lines}",
    "stage_target_accounts": f"""
    select account, service, servgrp_id from {{services}} where service = '30' and account in {_TARGETS}""",
    "billable_bills": "select bill_number, customer, account, bill_date, current_amount from {bills} where @real",
    "active_plans": """
    select e.customer, e.account, e.plan_type, e.start_date, e.stop_date, p.plan_class, p.draw
    from {plan_enrolments} e join {plan_types} p on p.plan_type = e.plan_type
    where @asof >= e.start_date and (@asof < e.stop_date + 1 or e.stop_date is null)""",
    "multiplier_profile": f"""
    select a.account_type, b.service, c.multiplier, count(*) as record_count
    from {{accounts}} a join {{services}} b on a.account = b.account
    left join {{multipliers}} c on b.service_id = c.servgrp_id
    where {_NUM_TARGET} group by a.account_type, b.service, c.multiplier""",
    "multiplier_coverage": f"""
    select count(*) as existing_multipliers from {{multipliers}} m
    join {{services}} s on m.servgrp_id = s.servgrp_id and m.service_group = s.service_group
    where m.multiplier = 1 and s.service = '30' and s.account in {_TARGETS}""",
    "service_accounts_semi": f"""
    select * from {{services}} where service = '30' and account in {_TARGETS}""",
    "payments_excluding_codes": """
    select trans_num, customer, account, trans_code, amount from {payments}
    where @settled and trans_code not in (select deposit_code from {deposit_codes})""",
    "unmatched_bf_addresses": """
    select * from {addresses} b where add_type = 'BF'
      and not exists (select 1 from {addresses} a where a.account = b.account and a.add_type = 'BM')""",
    "missing_system_txns": """
    select a.bill_number, a.batch_id, a.account, a.bill_date as trans_date, 'RF' as trans_code,
           c.amount_due_before as amount, cast(-1 as int) as trans_num, a.user_id, true as in_balance, 0 as sum_flag,
           false as is_penalty, false as is_hidden, '' as ar_code, '' as supplier, false as is_system_hidden,
           '' as service, false as in_cancel_section, 0 as wap, 2 as orig_tran, 2 as sort_no, true as is_taxed,
           0 as loan_num, 0 as orig_bill
    from {bills} a left join {bill_lines} b on a.bill_number = b.bill_number and b.trans_code = 'RF'
    left join {bills} c on a.orig_bill = c.bill_number
    where a.bill_type = 'CB' and a.processed and b.trans_code is null and a.bill_date > date '2000-01-01'""",
    "contact_recency": """
    select b.contact_info_id, b.account, b.phone_type, b.updated, max(a.updated) as new_updated,
           count(a.contact_info_id) as peers,
           case when b.updated > coalesce(max(a.updated), timestamp '1900-01-01') then 'BF is newer - UPDATE NEEDED'
                else 'BM is newer or equal - NO UPDATE NEEDED' end as update_status
    from (select * from {contacts} where add_type = 'BF') b
    left join (select * from {contacts} where add_type = 'BM') a
      on a.account = b.account and a.phone_type = b.phone_type
    group by b.contact_info_id, b.account, b.phone_type, b.updated""",
    "open_service_order_flag": """
    select customer, account, exists (select 1 from {service_orders} s where s.customer = p.customer
           and s.account = p.account and not s.is_cancelled and not s.is_completed) as service_order
    from (select distinct customer, account from {accounts}) p""",
    "latest_web_contact": """
    select customer, web_pk, email from {web_signups} w
    where web_pk = (select max(web_pk) from {web_signups} x where x.customer = w.customer)""",
    "payment_types_allowed": """
    select customer, account,
           coalesce((select string_agg(payment_type || ',', '' order by code) from {payment_types}
                     where instr(r.disallowed_types, code) = 0), '') as comment_code,
           coalesce((select string_agg(container || ',', '' order by code) from {payment_types}
                     where instr(r.disallowed_types, code) = 0), '') as container_name
    from {q_comment_codes} r""",
    "payment_history": """
    select customer, account, 1 as responsecode, payamount, pay_date as paydate from (
        select *, row_number() over (partition by customer, account order by pay_date desc, parent_tr) as rn
        from (select customer, account, parent_tr, pay_date, cast(sum(amount) * -1 as decimal(15,2)) as payamount
              from {payments}
              where @settled and trans_code in (select trans_code from {trans_codes} where trans_code like 'PA%')
              group by customer, account, parent_tr, pay_date))
    where rn <= 3""",
    "payment_history_by_batch": """
    select customer, account, 1 as responsecode, payamount, pay_date as paydate from (
        select *, row_number() over (partition by customer, account order by pay_date desc, batch_id) as rn
        from (select customer, account, batch_id, pay_date, cast(sum(amount) as decimal(15,2)) as payamount
              from {payments} where @settled group by customer, account, batch_id, pay_date))
    where rn <= 3""",
    "ar_balance": """
    select b.customer, b.account, cast(sum(b.current_balance) as decimal(15,2)) as ar_balance
    from {ar_balances} b join {ar_codes} c on c.ar_code = b.ar_code where c.in_balance
    group by b.customer, b.account""",
    "pending_payments": """
    select customer, account, cast(sum(amount) as decimal(15,2)) as pending_payment from (
        select customer, account, amount from {payments} where amount < 0 and not processed and parent_tr = 0
           and receipt = 0 and not is_deleted
           and trans_code in (select trans_code from {trans_codes} where transaction_type = 'CA')
        union all
        select customer, account, amount from {payments} where amount < 0 and not processed and receipt <> 0
           and not is_deleted and trans_code in (select trans_code from {trans_codes} where transaction_type = 'CA')
        union all select customer, account, amount from {ext_pending} where not processed)
    group by customer, account""",
    "pending_payments_v1": """
    select customer, account, cast(sum(amount) as decimal(15,2)) as pending_payment from (
        select customer, account, amount from {payments} where amount < 0 and not processed and parent_tr = 0
           and not is_deleted
        union all select customer, account, amount from {ext_pending} where not processed)
    group by customer, account""",
    "grace_days": """
    select customer, account, bill_number, account_type, bill_type,
           cast(coalesce((select sum(days) from {grace_days} g where g.account_type = b.account_type
                          and g.bill_type = b.bill_type), 0) as int) as grace_days
    from {q_current_bill} b""",
    "account_counts": """
    select count(*) as account_rows, count(distinct account) as distinct_accounts from {accounts}
    where account_type = 'BU' and division = '02'""",
    "staged_amount_stats": """
    select count(*) as total_records, cast(avg(amount) as decimal(15,2)) as average_amount,
           min(amount) as min_amount, max(amount) as max_amount from {q_missing_system_txns}""",
    "active_plans_on": """
    select d.as_of, e.customer, e.account, e.plan_type, e.start_date, e.stop_date, p.plan_class
    from (select distinct cast(date_trunc('month', bill_date) as date) + 1400 as as_of from {bills}) d
        join {plan_enrolments} e on e.start_date <= d.as_of and (e.stop_date is null or d.as_of <= e.stop_date)
        join {plan_types} p on p.plan_type = e.plan_type""",
    "staged_receivables": """
    select s.account, count(a.amount) as transactions, cast(coalesce(sum(a.amount), 0) as decimal(15,2)) as amount
    from (select distinct account from {q_stage_target_accounts}) s left join {ar_txns} a on a.account = s.account
    group by s.account""",
    "reconcile_above_mark": """
    with staged as (select * from {q_stage_target_accounts}), n as (select count(*) as rows from staged),
    verified as (
        select coalesce(sum(k * k), 0) as v from (select servgrp_id, count(*) as k from staged group by servgrp_id))
    select n.rows as staged_rows, n.rows as inserted_rows, cast(v as bigint) as verified_rows, n.rows = v as ok
    from n, verified""",
    "reconcile_counts": """
    select expected_rows, actual_rows, expected_rows = actual_rows as ok from
      (select count(*) as expected_rows from {q_missing_system_txns}),
      (select count(*) as actual_rows from (
          select trans_code, trans_num from {bill_lines} union all
          select trans_code, trans_num from {q_missing_system_txns})
       where trans_code = 'RF' and trans_num = -1)""",
    "exclude_codes": """
    select a.customer, a.account, b.codes as balance_codes,
           b.codes || case when p.plan_type is null then '' else p.exclude_credits end || ','
                   || case when p.plan_type is null then '' else p.exclude_debits end || ',' as exclude_codes
    from (select distinct customer, account from {accounts}) a
    left join {q_plan_status} p on p.customer = a.customer and p.account = a.account
    cross join (select string_agg(code || ',', '' order by code) as codes from (
        select credit_code as code from {ar_codes} where is_summary or in_balance
        union select debit_code from {ar_codes} where is_summary or in_balance) where code <> '') b""",
    "comment_codes": """
    with active as (
        select c.customer, c.account, k.comment_code, k.disallowed from {comments} c
        join {comment_codes} k on k.comment_code = c.comment_code
        where c.expiration_date is null or @asof < c.expiration_date + 1
    ), entries as (
        select distinct p.customer, p.account, a.comment_code, a.disallowed
        from (select distinct customer, account from {accounts}) p
        left join active a on a.customer = p.customer or a.account = p.account
    )
    select customer, account,
           coalesce(string_agg(comment_code || ',', '' order by comment_code, disallowed), '') as comment_type_code,
           case when count(comment_code) = 0 then ''
                when count(disallowed) < count(comment_code) then null
                else string_agg(disallowed || ',', '' order by comment_code, disallowed) end as disallowed_types
    from entries group by customer, account""",
    "next_ids": """
    select account, phone_type, contact_info_id,
           (select max(contact_info_id) from {contacts})
           + row_number() over (order by account, phone_type, contact_info_id) as new_id
    from {contacts} where add_type = 'BF'""",
    "last_payment": _last_payment("and trans_code not in (select distinct deposit_code from {deposit_codes})"),
    "last_payment_v1": _last_payment(""),
    "current_bill": """
    select customer, account, bill_date, coalesce(new_due_date, due_date) as bill_due_date,
           due_date as plain_due_date, current_amount as bill_amount, account_type, bill_type, amount_due_before,
           calc_ts, bill_number
    from (select *, row_number() over (partition by customer, account order by bill_date desc, bill_number desc) rn
          from {bills} where @real)
    where rn = 1""",
    "last_past_due_bill": """
    select customer, account, bill_number, bill_date, due_date
    from (select *, row_number() over (partition by customer, account order by bill_date desc, bill_number desc) rn
          from {bills} where @real and due_date < @asof)
    where rn = 1""",
    "account_cycle": """
    select customer, account, cycle
    from (select *, row_number() over (partition by customer, account order by effective_date desc, cycle desc) rn
          from {accounts})
    where rn = 1""",
    "arrangement_status": """
    with last as (
        select * from (select *, row_number() over (partition by customer, account
            order by arrange_date desc, group_id desc, amount desc, status desc) rn from {arrangements}) where rn = 1
    ), upcoming as (
        select * from (select *, row_number() over (partition by customer, account, group_id
            order by arrange_date, amount, status) rn from {arrangements} where arrange_date >= @asof) where rn = 1
    ), chosen as (
        select l.customer, l.account, coalesce(u.amount, l.amount) as amount,
               coalesce(u.arrange_date, l.arrange_date) as arrange_date, coalesce(u.status, l.status) as status
        from last l left join upcoming u on u.customer = l.customer and u.account = l.account
             and u.group_id = l.group_id and l.group_id > 0 and l.arrange_date > @asof - 1
    )
    select customer, account, amount as arrangement_amount, arrange_date as arrangement_date,
           case status when 'N' then 1 when 'B' then 2 when 'K' then 3 when 'P' then 4 else 5 end as arrangement_status
    from chosen""",
    "phone_by_priority": """
    select customer, phone_number, phone_type, phone_desc from (
        select c.customer, c.phone_number, c.phone_type, t.description as phone_desc,
               row_number() over (partition by c.customer order by w.pos, c.contact_info_id) as rn
        from {contacts} c join {phone_types} t on t.phone_type = c.phone_type
        join (values ('P3', 1), ('P11', 2), ('P5', 3), ('P7', 4)) w(phone_type, pos) on w.phone_type = c.phone_type
        where c.add_type = '' and c.phone_number <> '')
    where rn = 1""",
    "phone_by_priority_v1": """
    select customer, phone_number, phone_type, phone_desc from (
        select *, row_number() over (partition by customer order by pos) as place from (
            select c.customer, c.phone_type, w.pos, trim(right(c.phone_number, 20)) as phone_number,
                   trim(left(t.description, 15)) as phone_desc,
                   row_number() over (partition by c.customer, c.phone_type order by c.contact_info_id) as nth
            from {contacts} c join {phone_types} t on t.phone_type = c.phone_type
            join (values ('P3', 1), ('P11', 2), ('P5', 3), ('P7', 4)) w(phone_type, pos)
                on w.phone_type = c.phone_type
            where c.add_type = '')
        where nth = 1 and phone_number is not null and phone_desc is not null)
    where place = 1""",
    "sample_top_rows": """
    select bill_number, account, trans_date, amount from {q_missing_system_txns}
    order by trans_date desc, bill_number desc limit 5""",
    "card_type_recode": f"""
    select pay003_fk, {_RECODE} as card_type, description, transaction_code, external_source from {{card_types}}""",
    "card_type_expand": _expansions(),
    "expanded": """select pay003_fk, card_type, description, transaction_code, external_source
    from {q_card_type_recode} union all select * from {q_card_type_expand}""",
    "pos_card_types": _pos(),
    "card_type_pipeline": "select * from {q_expanded} union all select * from {q_pos_card_types}",
    "card_type_check": """
    select * from {q_card_type_pipeline} where card_type in ('VISA_DEBIT', 'MC_DEBIT', 'DISC_DEBIT', 'SAV',
        'PAYPAL_CREDIT', 'PAYPAL_ACCOUNT', 'WALMART_PAY', 'VENMO', 'GP', 'AP')""",
    "card_type_unmatched": """
    select card_type, count(*) as rows from {card_types} where card_type not in ('Visa', 'VISA', 'MasterCard', 'MC',
        'AmericanExpress', 'AMEX', 'Discover', 'DISC', 'eCheck', 'CHQ', 'PayPal', 'PAYPAL', 'WalmartPay',
        'WALMART_PAY', 'Venmo', 'VENMO', 'GooglePay', 'GP', 'ApplePay', 'AP') group by card_type""",
    "formatted_service_address": """
    select account, coalesce(cast(street_num as varchar), '') || ' '
             || coalesce((select description from {num_suffixes} where code = num_suffix), '') as street_number,
           coalesce((select description from {street_prefixes} p where p.street_prefix = a.street_prefix), '')
             || ' ' || street || ' ' || street_suffix || ' ' || apt as street_name,
           town as city_town, prov as state_prov, post_code as zip_postal
    from {service_addresses} a""",
    "formatted_service_address_v1": """
    select account, street_num_text || ' '
             || coalesce((select description from {num_suffixes} where code = num_suffix), '') as street_number,
           street_prefix || ' ' || street || ' ' || street_suffix || ' ' || apt as street_name,
           town as city_town, prov as state_prov, post_code as zip_postal
    from {service_addresses} a""",
    "business_days": """
    select bill_number, due_date, case when n = 0 then due_date
           else cast(friday + n + 2 * cast(floor((isodow(friday) - 1 + n) / 5) as int) as date) end as cut_date
    from (select bill_number, due_date, cast(bill_number % 25 as int) as n,
                 due_date - cast(greatest(isodow(due_date) - 5, 0) as int) as friday from {bills})""",
    "promote_addresses": """
    select * from {addresses} where add_type <> 'BF'
    union all
    select customer, account, 'BM', address1, email, send_bill, updated from {q_unmatched_bf_addresses}""",
    "promote_addresses_deleted": "select * from {addresses} where add_type = 'BF'",
    "promote_contacts": """
    select * from {contacts} where add_type <> 'BF'
    union all
    select (select max(contact_info_id) from {contacts})
             + row_number() over (order by account, phone_type, contact_info_id),
           null, customer, account, phone_type, phone_number, 'BM', updated, custom1, notes, preferred, contact_times
    from {contacts} b where add_type = 'BF' and not exists (
        select 1 from {contacts} a where a.account = b.account and a.phone_type = b.phone_type and a.add_type = 'BM')""",
    "sync_newer_contacts": """
    with source as (
        select * from (select *, row_number() over (partition by account, phone_type
            order by updated desc, contact_info_id desc) rn from {contacts} where add_type = 'BF') where rn = 1)
    select a.contact_info_id, a.contact_pk, a.customer, a.account, a.phone_type,
           case when b.account is null then a.phone_number else b.phone_number end as phone_number, a.add_type,
           case when b.account is null then a.updated else b.updated end as updated,
           case when b.account is null then a.custom1 else b.custom1 end as custom1,
           case when b.account is null then a.notes else b.notes end as notes,
           case when b.account is null then a.preferred else b.preferred end as preferred,
           case when b.account is null then a.contact_times else b.contact_times end as contact_times
    from {contacts} a left join source b on a.add_type = 'BM' and b.account = a.account
         and b.phone_type = a.phone_type and b.updated > a.updated""",
    "sync_newer_addresses": """
    with source as (
        select * from (select *, row_number() over (partition by account order by updated desc, address1 desc) rn
                       from {addresses} where add_type = 'BF') where rn = 1)
    select a.customer, a.account, a.add_type,
           case when b.account is null then a.address1 else b.address1 end as address1,
           case when b.account is null then a.email else b.email end as email,
           case when b.account is null then a.send_bill else b.send_bill end as send_bill,
           case when b.account is null then a.updated else b.updated end as updated
    from {addresses} a left join source b on a.add_type = 'BM' and b.account = a.account and b.updated > a.updated""",
    "web_contacts_insert": """
    select customer, 'E3' as phone_type, email as phone_number, cast(@asof as timestamp) as updated,
           pk as contact_pk, pk as contact_info_id
    from (select w.*, (select max(contact_pk) from {web_contacts}) + row_number() over (order by web_pk) as pk
          from {q_latest_web_contact} w where not exists (
              select 1 from {web_contacts} b where b.customer = w.customer and b.phone_type = 'E3'
              and b.phone_number = w.email))""",
    "web_contacts_table": """
    select case when phone_type = 'E3' then contact_pk else contact_info_id end as contact_info_id, contact_pk,
           customer, account, phone_type, phone_number, add_type, updated, custom1, notes, preferred, contact_times
    from {web_contacts}
    union all
    select contact_info_id, contact_pk, customer, null, phone_type, phone_number, null, updated, null, null, null, null
    from {q_web_contacts_insert}""",
    "multiplier_targets": f"""
    select a.customer, a.account, a.account_type, b.service, count(*) as record_count
    from {{accounts}} a join {{services}} b on a.account = b.account
    where {_NUM_TARGET} group by a.customer, a.account, a.account_type, b.service""",
    "multiplier_verification": f"""
    select a.customer, a.account, a.account_type, b.service, c.multiplier, count(*) as verified_count
    from {{accounts}} a join {{services}} b on a.account = b.account
    left join {{multipliers}} c on b.service_id = c.servgrp_id
    where {_NUM_TARGET} and c.multiplier = 1
    group by a.customer, a.account, a.account_type, b.service, c.multiplier""",
    "add_multipliers": f"""
    select b.service_id as servgrp_id, 1 as multiplier, cast(4 as decimal(15,2)) as basic_multiple, '' as notes,
           (select coalesce(max(multiplier_pk), 0) from {{multipliers}})
             + row_number() over (order by b.service_id) as multiplier_pk,
           b.install_date as start_date, date '1900-01-01' as end_date, b.service as service_group
    from {{services}} b join (select distinct b.service_id from {{accounts}} a
        join {{services}} b on a.account = b.account where {_NUM_TARGET}) c on c.service_id = b.service_id""",
    "add_multipliers_missing": """
    select servgrp_id, multiplier, basic_multiple, notes, (select max(multiplier_pk) from {multipliers})
             + row_number() over (order by servgrp_id) as multiplier_pk, start_date, end_date, service_group
    from {q_add_multipliers}
    where servgrp_id not in (select servgrp_id from {multipliers} where multiplier = 1)""",
    "add_multipliers_staged": """
    select servgrp_id, 1 as multiplier, cast(4 as decimal(15,2)) as basic_multiple,
           (select max(multiplier_pk) from {multipliers})
             + row_number() over (order by servgrp_id, account, service) as multiplier_pk,
           date '2023-01-01' as start_date, '30' as service_group
    from {q_stage_target_accounts}""",
    "checked_append": f"""
    select b as rows_before, n as rows_added, after as rows_after,
           n = wanted and verified >= n and after = b + n as ok
    from (select count(*) as b from {{multipliers}}), (select count(*) as n from {{q_add_multipliers}}),
         (select count(*) as after from (select multiplier_pk from {{multipliers}}
              union all select multiplier_pk from {{q_add_multipliers}})),
         (select count(distinct b.service_id) as wanted from {{accounts}} a
              join {{services}} b on a.account = b.account where {_NUM_TARGET}),
         (select count(*) as verified from {{accounts}} a join {{services}} b on a.account = b.account
              join {{q_add_multipliers}} c on c.servgrp_id = b.service_id
              where {_NUM_TARGET} and c.multiplier = 1)""",
    "plan_status": """
    select customer, account, plan_type, plan_class, draw, use_plan_balance,
           case when plan_class <> 'E' and plan_class <> 'L' then false else use_plan_billed end as use_plan_billed,
           exclude_credits, exclude_debits,
           case plan_class when 'E' then 1 when 'V' then 2 when 'L' then 3 else 0 end as plan_number
    from (select e.customer, e.account, p.*, row_number() over (partition by e.customer, e.account
              order by e.start_date desc, e.plan_type desc) as rn
          from {plan_enrolments} e join {plan_types} p on p.plan_type = e.plan_type
          where @asof >= e.start_date and (@asof < e.stop_date + 1 or e.stop_date is null))
    where rn = 1""",
    "plan_status_v1": """
    with active as (
        select e.customer, e.account, e.start_date, p.* from {plan_enrolments} e
        join {plan_types} p on p.plan_type = e.plan_type
        where @asof >= e.start_date and (@asof < e.stop_date + 1 or e.stop_date is null))
    select customer, account,
           arg_max(draw, (start_date, plan_type)) as draw,
           coalesce(bool_or(plan_type in ('EN', 'LN') and use_plan_balance), false) as use_plan_balance,
           cast(coalesce((select case plan_class when 'E' then 1 when 'V' then 2 else 3 end from active b
                where b.customer = a.customer and b.account = a.account and plan_class in ('E', 'V', 'L')
                order by start_date desc, plan_type desc limit 1), 0) as int) as plan_number
    from active a group by customer, account""",
    "current_balance": """
    select a.customer, a.account, cast(coalesce(case
             when p.plan_type is null or not p.use_plan_balance then r.ar_balance
             when p.plan_class in ('E', 'L') and p.use_plan_balance then b.plan_billed + b.credits end, 0)
           as decimal(15,2)) as current_balance
    from (select distinct customer, account from {accounts}) a
    left join {q_plan_status} p using (customer, account)
    left join {plan_balances} b using (customer, account)
    left join {q_ar_balance} r using (customer, account)""",
    "disconnect_date": """
    select customer, account, bill_due_date,
           case when bill_due_date is not null and account_type <> '' then bill_due_date + grace_days
                else date '1900-01-01' end as disconnect_date
    from {q_current_bill} b join {q_grace_days} g using (customer, account, account_type)""",
    "disconnect_date_business": """
    select customer, account, bill_due_date,
           case when bill_due_date is null or account_type = '' then date '1900-01-01'
                when grace_days = 0 then bill_due_date
                else cast(friday + grace_days + 2 * cast(floor((isodow(friday) - 1 + grace_days) / 5) as int) as date)
           end as disconnect_date
    from (select b.customer, b.account, b.bill_due_date, b.account_type, g.grace_days,
                 bill_due_date - cast(greatest(isodow(bill_due_date) - 5, 0) as int) as friday
          from {q_current_bill} b join {q_grace_days} g on g.customer = b.customer and g.account = b.account)""",
    "amount_due_before_due_date": """
    with paid as (
        select b.customer, b.account, b.amount_due_before
          + coalesce((select sum(a.amount) from {ar_txns} a where a.customer = b.customer and a.account = b.account
              and a.trans_date >= b.calc_ts and a.amount < 0 and a.bill_number = 0
              and not exists (select 1 from {bill_lines} l where l.account = a.account and l.trans_num = a.trans_num)
              and a.trans_code not in (select trans_code from {trans_codes} where transaction_type = 'AD')), 0)
          + coalesce((select sum(a.amount) from {ar_txns} a where a.customer = b.customer and a.account = b.account
              and not a.is_statement and a.amount > 0 and a.trans_date >= b.calc_ts
              and a.trans_code in (select trans_code from {trans_codes} where use_original_age)), 0) as left_over
        from {q_current_bill} b)
    select a.customer, a.account, cast(case when left_over is null then 0 when left_over < 0 then 0 else left_over end
             + coalesce(pending_payment, 0) as decimal(15,2)) as amount_due_before_due_date
    from (select distinct customer, account from {accounts}) a
    left join paid using (customer, account) left join {q_pending_payments} using (customer, account)""",
    "not_due_amount": """
    select p.customer, p.account, cast(sum(a.amount) as decimal(15,2)) as not_due_amount
    from (select distinct customer, account from {accounts}) p
    join {bill_lines} a on a.account = p.account and a.orig_bill = 0 and a.trans_num > 0
    join {bills} b on b.bill_number = a.bill_number
    join {trans_codes} c on c.trans_code = a.trans_code
    where b.due_date >= @asof and b.processed and a.sum_flag <> 5
      and (not a.in_balance or (a.in_balance and c.transaction_type <> 'CA' and a.amount > 0))
      and a.ar_code not in (select ar_code from {ar_codes} where deposit_paid or deposit_interest)
      and not exists (select 1 from {ar_txns} x join {trans_codes} g on g.trans_code = x.trans_code
                      where x.customer = p.customer and x.account = p.account and x.aging_date is not null and g.is_nsf
                        and x.trans_code = a.trans_code)
      and instr((select max(balance_codes) from {q_exclude_codes}), a.trans_code || ',') = 0
    group by p.customer, p.account""",
    "not_due_bills": """
    select customer, account, cast(sum(current_amount) as decimal(15,2)) as not_due_amount from {bills}
    where @real and due_date >= @asof group by customer, account""",
    "plan_past_due": """
    with bill as (
        select * from (select *, row_number() over (partition by customer, account
            order by due_date desc, bill_number desc) rn from {bills} where @real and due_date >= @asof) where rn = 1)
    select s.customer, s.account, cast(case when b.is_reconcile is null then c.current_balance
             else b.plan_bill + case when b.is_reconcile then b.plan_cred else 0 end
                  + case when s.use_plan_balance and s.plan_class in ('E', 'L') then coalesce(k.credits, 0) else 0 end
                  - coalesce((select sum(l.amount) from {bill_lines} l where l.bill_number = b.bill_number
                        and l.account = s.account and l.in_balance and l.sum_flag = 0 and l.amount > 0
                        and l.trans_num > 0 and l.orig_bill = 0
                        and instr(x.exclude_codes, l.trans_code || ',') = 0), 0)
             end as decimal(15,2)) as plan_past_due
    from {q_plan_status} s
    join {q_current_balance} c on c.customer = s.customer and c.account = s.account
    join {q_exclude_codes} x on x.customer = s.customer and x.account = s.account
    left join bill b on b.customer = s.customer and b.account = s.account
    left join {plan_balances} k on k.customer = s.customer and k.account = s.account
    where s.use_plan_billed""",
    "current_accounts": """
    select * exclude (rn) from (select *, row_number() over (partition by customer, account
        order by effective_date desc, account_status desc, cycle desc) as rn from {accounts}) where rn = 1""",
    "master_not_due": """
    with masters as (
        select a.*, row_number() over (partition by a.customer, a.account
            order by a.account_status desc, a.bill_group desc) as rn
        from {accounts} a join {bill_groups} g on g.bill_group = a.bill_group
        where a.is_master and g.updates_master)
    select a.customer, a.account, a.bill_group,
           cast(coalesce((select sum(current_amount) from {bills} b where b.bill_group = a.bill_group
                and not b.is_master and b.processed and b.bill_type <> 'CB' and b.due_date >= @asof), 0)
             as decimal(15,2)) as master_not_due
    from masters a where rn = 1""",
    "unbilled_amount": _unbilled(True),
    "unbilled_amount_plain": _unbilled(False),
    "nsf_amount": """
    select a.customer, a.account, cast(sum(a.amount) as decimal(15,2)) as nsf_amount
    from {ar_txns} a join {trans_codes} g on g.trans_code = a.trans_code
    left join {q_current_bill} b on b.customer = a.customer and b.account = a.account
    where a.trans_date > coalesce(b.bill_date, @asof) and a.amount > 0 and a.aging_date is null and g.is_nsf
    group by a.customer, a.account""",
    "past_due": _past_due(True),
    "past_due_plain": _past_due(False),
    "state_v1": """
    select a.*, b.bill_date, b.plain_due_date, b.bill_amount, b.bill_number, b.account_type as bill_account_type,
           b.bill_type, p.plan_number, p.draw, o.due_date as overdue,
           cast(coalesce(case when p.use_plan_balance then k.plan_billed + k.credits else r.ar_balance end, 0)
                as decimal(15,2)) as current_balance,
           coalesce((select sum(l.amount) from {bill_lines} l where l.bill_number = b.bill_number and l.in_balance
                and l.sum_flag = 0 and l.trans_num > 0 and l.amount > 0 and l.trans_code not in
                    (select trans_code from {trans_codes} where include_in_owing)), 0) as adjustments,
           coalesce((select sum(t.amount) from {ar_txns} t where t.customer = a.customer and t.account = a.account
                and t.amount > 0 and (t.bill_number <= 0 or not exists (select 1 from {bill_lines} l
                    where l.bill_number = t.bill_number and l.trans_num = t.trans_num))
                and t.trans_date > coalesce(b.bill_date, date '1900-01-01') and not t.is_statement
                and t.trans_code not in (select trans_code from {trans_codes} where include_in_owing)), 0) as later
    from {q_current_accounts} a
    left join {q_current_bill} b on b.customer = a.customer and b.account = a.account
    left join {q_plan_status_v1} p on p.customer = a.customer and p.account = a.account
    left join {plan_balances} k on k.customer = a.customer and k.account = a.account
    left join {q_ar_balance} r on r.customer = a.customer and r.account = a.account
    left join (select * from (select customer, account, due_date, row_number() over (partition by customer, account
                   order by bill_date desc, bill_number desc) rn from {bills} where @real and due_date <= @asof)
               where rn = 1) o on o.customer = a.customer and o.account = a.account""",
    "past_due_v1": """
    with first_step as (
        select *, case when @asof < plain_due_date + 1 then current_balance - bill_amount - adjustments
                       else current_balance end as owed from {q_state_v1})
    select customer, account, current_balance,
           cast(case when owed <= 0 then 0 when owed - later <= 0 then 0 else owed - later end as decimal(15,2))
               as past_due_amount,
           coalesce(case when owed > 0 and owed - later > 0 then coalesce(overdue, plain_due_date)
                         else plain_due_date end, date '1900-01-01') as due_date
    from first_step""",
    "cash_only": """
    with active as (
        select c.customer, c.account, k.comment_type from {comments} c
        join {comment_codes} k on k.comment_code = c.comment_code
        where k.cash_only and (c.expiration_date is null or @asof < c.expiration_date + 1))
    select customer, account,
           exists (select 1 from active a where a.account = p.account and a.comment_type = 'A')
           or exists (select 1 from active a where a.customer = p.customer) as cash_only
    from (select distinct customer, account from {accounts}) p""",
    "comment_restrictions": """
    select customer, account, c.comment_type_code, p.comment_code, p.container_name
    from {q_comment_codes} c join {q_payment_types_allowed} p using (customer, account)""",
    "comment_restrictions_v1": """
    with active as (
        select c.comment_id, c.customer, c.account,
               coalesce((select string_agg(payment_type || ',', '' order by code) from {payment_types}
                         where instr(k.disallowed, code) = 0 and payment_type <> ''), '') as allowed
        from {comments} c join {comment_codes} k on k.comment_code = c.comment_code
        where not k.cash_only and (c.expiration_date is null or @asof < c.expiration_date + 1)
    ), own as (
        select account, arg_min(allowed, comment_id) as allowed from active group by account
    ), other as (
        select customer, arg_min(allowed, comment_id) as allowed from active group by customer)
    select p.customer, p.account,
           case when own.allowed is null or own.allowed = '' then other.allowed else own.allowed end as comment_code
    from (select distinct customer, account from {accounts}) p
    left join own on own.account = p.account left join other on other.customer = p.customer""",
    "ivr_status": """
    select a.customer, a.account, a.account_status, a.col_status, d.past_due_amount,
           case when a.account_status = 'AC' and d.past_due_amount = 0 then 1
                when a.account_status <> 'AC' then 2
                when a.col_status = (select min(disconnect_status) from {collection_settings}
                                     where disconnect_status <> '') then 4
                when a.col_status = (select min(pending_status) from {collection_settings}
                                     where pending_status <> '') then 3
                else 5 end as ivr_status
    from {q_current_accounts} a join {q_past_due} d on d.customer = a.customer and d.account = a.account""",
    "account_summary": """
    select a.customer, a.account, a.pin, d.current_balance as currentbalance, a.account_status as accountstatus,
           i.ivr_status as ivrstatus, coalesce(b.bill_date, date '1900-01-01') as billdate,
           case when b.bill_number is null then date '1900-01-01' else b.bill_due_date end as billduedate,
           coalesce(b.bill_amount, 0) as billamount, d.past_due_amount as pastdueamount,
           cu.first_name as firstname, cu.last_name as lastname, sa.street_number as streetnumber,
           sa.street_name as streetname, sa.city_town as citytown, sa.state_prov as stateprov,
           sa.zip_postal as zippostal, coalesce(lp.payment_amount, 0) as paymentamount,
           coalesce(lp.payment_date, date '1900-01-01') as paymentdate, a.col_status as colstatuscode,
           co.cash_only as cashonly, coalesce(dd.disconnect_date, date '1900-01-01') as disconnectdate,
           cast(coalesce(w.pending_payment, 0) as decimal(15,2)) as pendingpayment,
           coalesce(p.plan_number, 0) as paymentplantype,
           case when p.plan_type is null then false else p.draw end as drawpayment,
           coalesce(ar.arrangement_amount, 0) as arrangementamount,
           coalesce(ar.arrangement_date, date '1900-01-01') as arrangementdate,
           coalesce(ar.arrangement_status, 0) as arrangementstatus, coalesce(ph.phone_number, '') as phonenumber,
           coalesce(ph.phone_type, '') as phonetype, coalesce(ph.phone_desc, '') as phonedesc,
           cr.comment_code as commentcode, a.cycle, so.service_order as serviceorder,
           d.past_due_date as pastduedate, am.amount_due_before_due_date as amountduebeforeduedate,
           cr.comment_type_code as commenttypecode, cr.container_name as containername,
           coalesce(b.bill_number, 0) as billnumber, 1 as responsecode
    from {q_current_accounts} a
        join {q_past_due} d using (customer, account)
        join {q_ivr_status} i using (customer, account)
        join {q_amount_due_before_due_date} am using (customer, account)
        join {q_open_service_order_flag} so using (customer, account)
        left join {q_current_bill} b using (customer, account)
        left join {q_disconnect_date} dd using (customer, account)
        left join {q_plan_status} p using (customer, account)
        left join {q_pending_payments} w using (customer, account)"""
    + _SUMMARY_TAIL % {"pay": "", "v": ""},
    "account_summary_v1": """
    select a.customer, a.account, a.pin, a.current_balance as currentbalance, a.account_status as accountstatus,
           case when a.account_status = 'AC' and d.past_due_amount = 0 then 1
                when a.account_status <> 'AC' then 2 when a.col_status = 'PD' then 3 when a.col_status = 'DC' then 4
                else 5 end as ivrstatus,
           coalesce(a.bill_date, date '1900-01-01') as billdate, d.due_date as billduedate,
           coalesce(a.bill_amount, 0) as billamount, d.past_due_amount as pastdueamount,
           cu.first_name as firstname, cu.last_name as lastname, sa.street_number as streetnumber,
           sa.street_name as streetname, sa.city_town as citytown, sa.state_prov as stateprov,
           sa.zip_postal as zippostal, coalesce(lp.payment_amount, 0) as paymentamount,
           coalesce(lp.payment_date, date '1900-01-01') as paymentdate, a.col_status as colstatuscode,
           co.cash_only as cashonly,
           case when a.plain_due_date is not null and a.bill_account_type <> '' then a.plain_due_date + coalesce((
                    select cast(sum(days) as int) from {grace_days} g where g.account_type = a.bill_account_type
                    and g.bill_type = a.bill_type), 0) else date '1900-01-01' end as disconnectdate,
           cast(coalesce(w.pending_payment, 0) as decimal(15,2)) as pendingpayment,
           coalesce(a.plan_number, 0) as paymentplantype,
           case when a.plan_number is null then false else a.draw end as drawpayment,
           coalesce(ar.arrangement_amount, 0) as arrangementamount,
           coalesce(ar.arrangement_date, date '1900-01-01') as arrangementdate,
           coalesce(ar.arrangement_status, 0) as arrangementstatus, coalesce(ph.phone_number, '') as phonenumber,
           coalesce(ph.phone_type, 'P3') as phonetype, coalesce(ph.phone_desc, '') as phonedesc,
           1 as responsecode, cr.comment_code as commentcode
    from {q_state_v1} a
        join {q_past_due_v1} d using (customer, account)
        left join {q_pending_payments_v1} w using (customer, account)"""
    + _SUMMARY_TAIL % {"pay": "_v1", "v": "_v1"},
    "billing_history": """
    select 1 as responsecode, customer as customernumber, account as accountnumber, bill_number as billnumber,
           due_date as duedate, bill_date as billdate, current_amount as billamount,
           cast(case when plan_type like 'L%' then balance_forward
                else balance_forward + cancelled_billing + since_last_bill + previous_billing end
             as decimal(15,2)) as owing
    from {bills} where @real and bill_date between date '1999-01-01' and date '2000-12-31'""",
    "billing_history_lookup": """
    with read as (
        select r.*, case when trim(first_text) = '' then date '1900-01-01' else @date(first_text) end as d1,
               case when trim(last_text) = '' then date '1900-01-01' else @date(last_text) end as d2,
               exists (select 1 from {accounts} a where a.customer = r.customer and a.account = r.account) as known
        from {lookup_requests} r
    ), judged as (
        select *, known and (first_text is null or d1 is not null) and (last_text is null or d2 is not null) as valid
        from read)
    select j.request_id, 1 as responsecode, b.customer as customernumber, b.account as accountnumber,
           b.bill_number as billnumber, b.due_date as duedate, b.bill_date as billdate,
           b.current_amount as billamount,
           cast(case when b.plan_type like 'L%' then b.balance_forward
                else b.balance_forward + b.cancelled_billing + b.since_last_bill + b.previous_billing end
             as decimal(15,2)) as owing
    from judged j join (select * from {bills} where @real) b on b.customer = j.customer and b.account = j.account
    where j.valid and b.bill_date between j.d1 and j.d2
    union all
    select request_id, 0, 0, 0, 0, date '1900-01-01', date '1900-01-01', 0, 0 from judged where not valid""",
    "payment_history_lookup": """
    with judged as (
        select r.*, exists (select 1 from {accounts} a where a.customer = r.customer and a.account = r.account) as valid
        from {lookup_requests} r)
    select j.request_id, h.responsecode, h.payamount, h.paydate
    from judged j join {q_payment_history} h on h.customer = j.customer and h.account = j.account where j.valid
    union all select request_id, 0, 0, date '1900-01-01' from judged where not valid""",
    "account_lookup": """
    with newest as (
        select account, customer, max(effective_date) as since,
               arg_max(account_status, effective_date::varchar || account_status) as status
        from {accounts} group by account, customer
    ), chosen as (
        select account, customer, count(*) over (partition by account) as customers,
               row_number() over (partition by account order by status = 'AC' desc, since desc, customer desc) as rn
        from newest
    )
    select r.request_id, r.account, coalesce(c.customer, 0) as customer,
           case when c.account is null then 0 when c.customers = 1 then 1 else 2 end as responsecode,
           case when c.account is null then date '1900-01-01' else b.bill_date end as bill_date,
           case when c.account is null then 0 else b.bill_amount end as bill_amount
    from {lookup_requests} r left join chosen c on c.account = r.account and c.rn = 1
    left join {q_current_bill} b on b.customer = c.customer and b.account = c.account""",
    "validated_lookup": """
    select r.request_id, r.customer, r.account, case when k.account is null then 0 else 1 end as responsecode,
           case when k.account is null then 0 else c.current_balance end as current_balance,
           case when k.account is null then date '1900-01-01' else b.bill_date end as bill_date,
           case when k.account is null then 0 else b.bill_amount end as bill_amount
    from {lookup_requests} r
    left join (select distinct customer, account from {accounts}) k
        on k.customer = r.customer and k.account = r.account
    left join {q_current_balance} c on c.customer = r.customer and c.account = r.account
    left join {q_current_bill} b on b.customer = r.customer and b.account = r.account""",
}

ORACLES["versioned_append"] = ORACLES["checked_append"]
ORACLES["sync_newer_contacts_touched"] = ORACLES["sync_newer_contacts"]
ORACLES["promote_addresses_touched"] = ORACLES["promote_addresses"]
ORACLES["card_type_recode_touched"] = ORACLES["card_type_recode"]
ORACLES["unbilled_amount_unique"] = ORACLES["unbilled_amount"]

# helper texts that are no query of their own
_HELPERS = {"expanded", "current_accounts", "state_v1"}


# Forms of a date text.
_FORMS = "['%Y-%m-%d', '%Y%m%d', '%m/%d/%Y', '%m-%d-%Y', '%m.%d.%Y', '%Y/%m/%d', '%Y.%m.%d', '%b %d, %Y', '%b %d %Y', '%d %b %Y', '%Y-%m-%d %H:%M:%S']"


def _marked(text: str) -> str:
    for name in ("first_text", "last_text"):
        text = text.replace(f"@date({name})", f"cast(try_strptime(trim({name}), {_FORMS}) as date)")
    for mark, value in _MARKS.items():
        text = text.replace(mark, value)
    return text


def oracle_texts() -> dict[str, str]:
    """One self-contained WITH query per registered query."""
    extra = {f"q_{name}": _marked(text) for name, text in ORACLES.items()}
    texts = {}
    for name in ORACLES:
        if name in _HELPERS:
            continue
        parts = as_ctes(f"q_{name}", extra)
        ctes = ",\n".join(f"{n} as ({text})" for n, text in parts)
        texts[name] = f"with {ctes}\nselect * from q_{name}"
    return texts
