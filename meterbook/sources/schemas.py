"""Column names of the billing system's tables, and the names used here."""

# The type that a column-name prefix stands for.
TYPE_BY_PREFIX = {
    "C": "string",
    "D": "date",
    "T": "timestamp_ntz",
    "Y": "decimal(15,2)",
    "N": "decimal(15,2)",
    "L": "boolean",
    "I": "bigint",
    "M": "string",
}

# Source table -> {source column: name used by the operators}.
SOURCE_TABLES = {
    "BIF000": {"L_INCLPENDINGPAYMENTFORPASTDUE": "pending_in_past_due"},
    "BIF001": {"C_CUSTOMER": "customer", "C_FIRSTNAME": "first_name", "C_LASTNAME": "last_name"},
    "BIF002": {
        "C_ACCOUNT": "account",
        "N_STREETNUM": "street_num",
        "C_STREETNUM": "street_num_text",
        "C_STRNUMSUFFIX": "num_suffix",
        "C_STREETPREFIX": "street_prefix",
        "C_STREET": "street",
        "C_STREETSUFFIX": "street_suffix",
        "C_APT": "apt",
        "C_TOWN": "town",
        "C_PROV": "prov",
        "C_POSTCODE": "post_code",
    },
    "BIF003": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_ACCOUNTTYPE": "account_type",
        "C_DIVISION": "division",
        "C_COMPANY": "company",
        "C_CYCLE": "cycle",
        "C_BILLGROUP": "bill_group",
        "C_ACCOUNTSTATUS": "account_status",
        "L_MASTER": "is_master",
        "D_EFFECTIVEDATE": "effective_date",
    },
    "BIF004": {
        "C_ACCOUNT": "account",
        "C_SERVICE": "service",
        "I_SERVGRPID": "servgrp_id",
        "I_SERVICEID": "service_id",
        "C_SERVICEGROUP": "service_group",
        "D_DATEINSTALLED": "install_date",
    },
    "BIF006": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_ADDTYPE": "add_type",
        "C_ADDRESS1": "address1",
        "C_EMAIL": "email",
        "L_SENDBILL": "send_bill",
        "T_DATETIME": "updated",
    },
    "BIF007": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "Y_AMOUNT": "amount",
        "D_ARRANGE": "arrange_date",
        "C_STATUS": "status",
        "I_GROUP": "group_id",
    },
    "BIF010": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_PHONETYPE": "phone_type",
        "C_PHONENUMBER": "phone_number",
        "C_ADDTYPE": "add_type",
        "T_UPDATED": "updated",
        "L_CUSTOM1": "custom1",
        "M_NOTES": "notes",
        "L_PREFERRED": "preferred",
        "C_CONTACTTIMES": "contact_times",
        "I_CONTACTINFOID": "contact_info_id",
        "I_BIF010PK": "contact_pk",
    },
    "BIF017": {
        "I_BIF017PK": "comment_id",
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_COMMENTCODE": "comment_code",
        "D_EXPIRATIONDATE": "expiration_date",
    },
    "BIF023": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "L_CANCELLED": "is_cancelled",
        "L_COMPLETED": "is_completed",
    },
    "BIF040": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_ARCODE": "ar_code",
        "Y_CURRENTBALANCE": "current_balance",
    },
    "BIF041": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "I_BILLNUMBER": "bill_number",
        "I_TRANSNUM": "trans_num",
        "I_LINKEDTRANSNUM": "linked_trans_num",
        "C_TRANSCODE": "trans_code",
        "Y_AMOUNT": "amount",
        "T_TRANSDT": "trans_date",
        "D_AGING": "aging_date",
        "L_STATEMENT": "is_statement",
    },
    "BIF071": {"C_BILLGROUP": "bill_group", "L_UPDATEBILLTRANSTOMASTER": "updates_master"},
    "BIF205": {
        "I_BIF205PK": "multiplier_pk",
        "I_SERVGRPID": "servgrp_id",
        "I_MULTIPLIER": "multiplier",
        "N_BASICMULTIPLE": "basic_multiple",
        "C_NOTES": "notes",
        "D_STARTDATE": "start_date",
        "D_ENDDATE": "end_date",
        "C_SERVICEGROUP": "service_group",
    },
    "BIF503": {"I_BATCHID": "batch_id", "C_TRANSACTIONTYPE": "transaction_type"},
    "BIF951": {
        "I_BILLNUMBER": "bill_number",
        "I_ORGBILL": "orig_bill",
        "I_BATCHID": "batch_id",
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_ACCOUNTTYPE": "account_type",
        "C_BILLTYPE": "bill_type",
        "C_PLANTYPE": "plan_type",
        "C_BILLGROUP": "bill_group",
        "C_USERID": "user_id",
        "D_BILLDATE": "bill_date",
        "D_DUEDATE": "due_date",
        "D_NEWDUEDATE": "new_due_date",
        "T_CALC": "calc_ts",
        "Y_CURRENTTRANSACTIONS": "current_amount",
        "Y_AMOUNTDUEBEFOREDUEDATE": "amount_due_before",
        "Y_BALANCEFORWARD": "balance_forward",
        "Y_CANCELLEDBILLING": "cancelled_billing",
        "Y_TRANSACTIONSSINCELASTBILL": "since_last_bill",
        "Y_PREVIOUSBILLING": "previous_billing",
        "Y_PLANBILL": "plan_bill",
        "Y_PLANCRED": "plan_cred",
        "L_RECONCIL": "is_reconcile",
        "L_CANCEL": "is_cancelled",
        "L_NOBILL": "no_bill",
        "L_PROCESSED": "processed",
        "L_MASTER": "is_master",
    },
    "BIF955": {
        "I_BILLNUMBER": "bill_number",
        "I_BATCHID": "batch_id",
        "C_ACCOUNT": "account",
        "T_TRANSDT": "trans_date",
        "C_TRANSCODE": "trans_code",
        "N_AMOUNT": "amount",
        "I_TRANSNUM": "trans_num",
        "C_USERID": "user_id",
        "L_BIF042": "in_balance",
        "N_SUMFLAG": "sum_flag",
        "L_PENALTY": "is_penalty",
        "L_HIDDEN": "is_hidden",
        "C_ARCODE": "ar_code",
        "C_SUPPLIER": "supplier",
        "L_SYS_HIDE": "is_system_hidden",
        "C_SERVICE": "service",
        "L_CANCELSECTION": "in_cancel_section",
        "N_WAP": "wap",
        "I_ORIGTRAN": "orig_tran",
        "N_SORT": "sort_no",
        "L_TAXED": "is_taxed",
        "I_LOANNUM": "loan_num",
        "I_ORIGBILL": "orig_bill",
    },
    "BIF956": {
        "I_TRANSNUM": "trans_num",
        "I_PARENTTR": "parent_tr",
        "I_RECEIPT": "receipt",
        "I_BATCHID": "batch_id",
        "I_PBILLNUM": "paid_bill",
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_TRANSCODE": "trans_code",
        "C_ARCODE": "ar_code",
        "Y_AMOUNT": "amount",
        "D_PAYDATE": "pay_date",
        "L_PROCESSED": "processed",
        "L_DELETED": "is_deleted",
    },
    "UTL045": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "Y_AMOUNT": "amount",
        "L_PROCESSED": "processed",
    },
    "PAP001": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "C_PLANTYPE": "plan_type",
        "D_STARTDATE": "start_date",
        "D_STOPDATE": "stop_date",
    },
    "PAP002": {
        "C_PLANTYPE": "plan_type",
        "C_TYPE": "plan_class",
        "L_DRAW": "draw",
        "L_USEBALANCEINPAP003": "use_plan_balance",
        "L_USEPLANBILLEDAMTFORPREVBILL": "use_plan_billed",
        "C_EXCLUDECREDITTRANSCODES": "exclude_credits",
        "C_EXCLUDEDEBITTRANSCODES": "exclude_debits",
    },
    "PAP003": {
        "C_CUSTOMER": "customer",
        "C_ACCOUNT": "account",
        "Y_PLANBILLED": "plan_billed",
        "Y_CREDITS": "credits",
    },
    "GLE001": {
        "C_TRANSCODE": "trans_code",
        "C_TRANSACTIONTYPE": "transaction_type",
        "L_INCLUDEINBALANCEOWING": "include_in_owing",
        "L_USEORIGINALAGE": "use_original_age",
        "L_NSFTRANSACTION": "is_nsf",
    },
    "CON008": {"C_ACCOUNTTYPE": "account_type", "C_BILLTYPE": "bill_type", "I_DAYS": "days"},
    "CON014": {"C_PHONETYPE": "phone_type", "C_DESCRIPTION": "description"},
    "CON081": {
        "C_COMMENTCODE": "comment_code",
        "L_CASHONLY": "cash_only",
        "C_TYPE": "comment_type",
        "C_DISALLOWEDPAYMENTTYPES": "disallowed",
    },
    "CON082": {"C_CODE": "code", "C_PAYMENTTYPE": "payment_type", "C_CONTAINERNAME": "container"},
    "CON091": {
        "C_ARCODE": "ar_code",
        "L_BIF042": "in_balance",
        "L_SUMMARY": "is_summary",
        "L_DEPOSITPAID": "deposit_paid",
        "L_DEPOSITINTEREST": "deposit_interest",
        "C_CREDITTRANSCODE": "credit_code",
        "C_DEBITTRANSCODE": "debit_code",
    },
    "CON103": {"C_DEPOSITPAIDTRANSCODE": "deposit_code"},
    "CON137": {"C_STREETPREFIX": "street_prefix", "C_DESCRIPTION": "description"},
    "CON151": {"C_CODE": "code", "C_DESCRIPTION": "description"},
    "COL109": {"C_PENDINGDISCONNECTSTATUS": "pending_status", "C_DISCONNECTSTATUS": "disconnect_status"},
    "WEB003": {"I_WEB003PK": "web_pk", "C_CUSTOMER": "customer", "C_EMAIL": "email"},
    "PAY005": {
        "I_PAY003FK": "pay003_fk",
        "C_CARDTYPE": "card_type",
        "C_DESCRIPTION": "description",
        "C_TRANSACTIONCODE": "transaction_code",
        "C_EXTERNALSOURCE": "external_source",
    },
    "INT100": {"I_INTEGKEY": "integ_key", "C_EXTERNALVALUE": "external_value", "C_CISVALUE": "internal_code"},
}
