"""SQL that states each query's result the plain way, for checking on another engine.

Joins are written out as pairs, EXISTS stays EXISTS, the mule rule is a self-join: the
text follows the definitions and not the way the Spark plans compute them. Only the
derivation of the input tables is shared.
"""

import re

from tracewell.sources.fixtures import (
    BENEFICIARY_RULES,
    LOGIN_RULES,
    STEP_RULE,
    STEPS,
    TRANSACTION_RULES,
    USER_RULES,
)

RISKY = "('North Korea', 'Iran', 'Syria', 'Myanmar', 'Russia')"


def _columns(rules: dict[str, str]) -> str:
    return ", ".join(f'{rule.format(ts="timestamp")} as "{name}"' for name, rule in rules.items())


PARTS = {
    "u": f"select {_columns(USER_RULES)} from customer",
    "b": f"select {_columns(BENEFICIARY_RULES)} from supplier",
    "l": f"""select {_columns(LOGIN_RULES)} from (
        select e.event_id, e.user_id, e.ts, u.home_latitude, u.home_longitude
        from events e join u on e.user_id = u.user_id where e.event_type not in ('purchase', 'click'))""",
    "t": f"""select * replace ("timestamp" as "timestamp") from (select {_columns(TRANSACTION_RULES)}
        from (select e.*, unnest([{", ".join(map(str, STEPS))}]) as step from events e
              where e.event_type in ('purchase', 'click'))
        where {STEP_RULE})""",
    "ratio": """select t.transaction_id, round(least(t.amount / nullif(u.wallet_balance, 0), 1.0), 4) as ratio
        from t join u on t.user_id = u.user_id""",
    "clock": """select transaction_id, (hour("timestamp") < 6 or hour("timestamp") >= 23) as is_off_hours,
        isodow("timestamp") in (6, 7) as is_weekend from t""",
    "profile": f"""select t.transaction_id,
        greatest(cast(extract(day from (t."timestamp" - b.created_at)) as bigint), 0) as age,
        (t."timestamp" - b.created_at) < interval '30' day as is_new,
        b.beneficiary_country in {RISKY} as risky
        from t join b on t.beneficiary_id = b.beneficiary_id""",
    "history": """select transaction_id, count(*) over (partition by user_id order by "timestamp"
        range between interval '7' day preceding and current row) - 1 as n from t""",
    "latest": """select * from (select t.transaction_id, t."timestamp" as ts, l.*, u.home_latitude, u.home_longitude,
        row_number() over (partition by t.transaction_id order by l.login_timestamp desc, l.auth_id desc) as rn
        from t join l on t.user_id = l.user_id and l.login_timestamp <= t."timestamp"
        join u on t.user_id = u.user_id) where rn = 1""",
    "access": """select t.transaction_id,
        case when x.transaction_id is null then 10
            else greatest(cast(round(epoch(x.ts - x.login_timestamp) / 60) as bigint), 0) end as minutes,
        coalesce(x.device_id not like 'device_legit%', false) as is_new_device,
        coalesce(round(case when x.transaction_id is not null then 6371 * acos(least(1.0, greatest(-1.0,
            cos(radians(cast(x.home_latitude as double))) * cos(radians(cast(x.ip_latitude as double)))
            * cos(radians(cast(x.ip_longitude as double)) - radians(cast(x.home_longitude as double)))
            + sin(radians(cast(x.home_latitude as double))) * sin(radians(cast(x.ip_latitude as double)))))) end, 2),
            0.0) as km
        from t left join latest x on t.transaction_id = x.transaction_id""",
    "feat": """select t.*, r.ratio, k.is_off_hours, k.is_weekend, p.age, p.is_new, p.risky, h.n, a.minutes,
        a.is_new_device, a.km
        from t left join ratio r using (transaction_id) left join clock k using (transaction_id)
        left join profile p using (transaction_id) left join history h using (transaction_id)
        left join access a using (transaction_id)""",
    "repaired": """select f.transaction_id, f.user_id, f.beneficiary_id, abs(f.amount) as amount,
        case when f."timestamp" < u.created_at then u.created_at + interval '5' minute else f."timestamp" end as ts,
        f.merchant_country, case when f.fraud_score is not null
            then least(1.0, greatest(0.0, cast(f.fraud_score as double))) end as fraud_score,
        coalesce(f.ratio, 0.0) as ratio, abs(coalesce(f.km, 0.0)) as km, abs(coalesce(f.n, 0)) as n,
        abs(f.minutes) as minutes, abs(f.age) as age, abs(f.age) < 30 as is_new,
        coalesce(f.is_off_hours, false) as is_off_hours, coalesce(f.is_weekend, false) as is_weekend,
        coalesce(f.is_new_device, false) as is_new_device, coalesce(f.risky, false) as risky
        from feat f join u on f.user_id = u.user_id
        where f.beneficiary_id in (select beneficiary_id from b)""",
    "c": """select * from (select *, row_number() over (partition by user_id, beneficiary_id, amount, ts
        order by transaction_id) as rn from repaired) where rn = 1""",
    "login_history": """select *,
        lag(login_timestamp) over (partition by user_id order by login_timestamp, auth_id) as prev_login_timestamp,
        lag(ip_latitude) over (partition by user_id order by login_timestamp, auth_id) as prev_ip_latitude,
        lag(ip_longitude) over (partition by user_id order by login_timestamp, auth_id) as prev_ip_longitude
        from l""",
    "jumps": """select user_id, login_timestamp from login_history
        where prev_login_timestamp is not null
        and power(cast(ip_latitude as double) - cast(prev_ip_latitude as double), 2)
          + power(cast(ip_longitude as double) - cast(prev_ip_longitude as double), 2) > 1.0
        and epoch(login_timestamp - prev_login_timestamp) / 3600 < 2""",
    "r1": f"""select c.transaction_id from c join b on c.beneficiary_id = b.beneficiary_id
        where c.amount between 9000000 and 9999999 and b.beneficiary_country in {RISKY}
        and (coalesce(c.is_new, true) or b.created_at >= c.ts - interval '30' day)""",
    "r2": """select transaction_id from (select transaction_id, count(*) over (partition by user_id order by ts
        range between interval '5' minute preceding and current row) as k from c) where k > 3""",
    "r3": f"select transaction_id from c where merchant_country in {RISKY} and amount > 1000000",
    "r4": """select c.transaction_id from c join b on c.beneficiary_id = b.beneficiary_id
        where c.amount between 9000000 and 9999999
        and (coalesce(c.is_new, true) or b.created_at >= c.ts - interval '7' day)""",
    "r5": """select transaction_id from c where amount >= 10000000 and exists (
        select 1 from jumps j where j.user_id = c.user_id and j.login_timestamp <= c.ts)""",
    "r6": """select c1.transaction_id from c c1 join c c2 on c1.beneficiary_id = c2.beneficiary_id
        and c2.ts between c1.ts - interval '1' hour and c1.ts
        group by c1.transaction_id having count(distinct c2.user_id) >= 4""",
    "fired": """select transaction_id, 1 as k, 'biometric_structuring_rule' as rule_name from r1
        union all select transaction_id, 2, 'velocity_rule' from r2
        union all select transaction_id, 3, 'cross_border_fraud_rule' from r3
        union all select transaction_id, 4, 'biometric_evasion_rule' from r4
        union all select transaction_id, 5, 'impossible_travel_rule' from r5
        union all select transaction_id, 6, 'circular_17_mule_network_rule' from r6""",
    "flags": """select c.*, coalesce(g.rule_flags, '') as rule_flags, coalesce(g.k, 0) as k from c left join (
        select transaction_id, string_agg(rule_name, '|' order by k) as rule_flags, count(*) as k
        from fired group by transaction_id) g using (transaction_id)""",
    "flat": """select t.transaction_id, t.user_id,
        case when t.transaction_id % 97 = 0 then null else t.beneficiary_id end as beneficiary_id,
        cast(t.amount as double) as amount, t."timestamp" as ts, u.phone as phone_number,
        cast(x.ip_latitude as double) as ip_latitude, cast(x.ip_longitude as double) as ip_longitude,
        cast(u.home_latitude as double) as home_latitude, cast(u.home_longitude as double) as home_longitude,
        case when t.transaction_id % 5 = 0 then null else t.transaction_id % 3 = 0 end as is_new
        from t left join latest x on t.transaction_id = x.transaction_id left join u on t.user_id = u.user_id""",
    "pieces": """select * replace (regexp_replace(phone_number, '^(\\+84|84)', '0') as phone_number,
        abs(amount) as amount, coalesce(is_new, true) as is_new),
        row_number() over (partition by user_id, beneficiary_id, abs(amount), ts order by transaction_id) as rn
        from flat""",
    "p": """select *, (hour(ts) >= 23 or hour(ts) < 5) as is_off_hours, dayofweek(ts) in (0, 6) as is_weekend,
        (amount between 9000000 and 9999999 and is_new) as flag,
        case when ip_latitude is not null and home_latitude is not null then 6371 * acos(least(1.0, greatest(-1.0,
            cos(radians(home_latitude)) * cos(radians(ip_latitude)) * cos(radians(ip_longitude) - radians(home_longitude))
            + sin(radians(home_latitude)) * sin(radians(ip_latitude))))) end as km
        from pieces where rn = 1 and user_id is not null and beneficiary_id is not null""",
    "totals": """select count(*) as n, count(*) filter (where flag) as hits, sum(cast(amount as decimal(28,10))) as money,
        coalesce(sum(cast(amount as decimal(28,10))) filter (where flag), 0) as risk from p""",
}


def _needed(text: str) -> list[str]:
    """Parts that a text mentions, with the parts these need, in the order of PARTS."""
    found: set[str] = set()
    queue = [text]
    while queue:
        words = set(re.findall(r"(?:from|join)\s+(\w+)", queue.pop()))
        for name in (words & PARTS.keys()) - found:
            found.add(name)
            queue.append(PARTS[name])
    return [name for name in PARTS if name in found]


# Parts that others spell out several times: computed once.
ONCE = {"t", "l", "u", "latest"}


def _check(text: str) -> str:
    parts = ",\n".join(f"{name} as {'materialized ' * (name in ONCE)}({PARTS[name]})" for name in _needed(text))
    return f"with {parts}\n{text}"


def _phone(column: str) -> str:
    return f"""case when {column} like '+84%' then '0' || substring({column}, 4)
        when {column} like '84%' then '0' || substring({column}, 3) else {column} end"""


def _rule(part: str) -> str:
    return f"select transaction_id from {part}"


def _pct(part: str, whole: str) -> str:
    return f"cast(round(100.0 * {part} / nullif({whole}, 0), 2) as double)"


FEATURES = """cast(ratio as double) as transaction_balance_ratio, is_new as is_beneficiary_new, is_off_hours,
    is_weekend, km as distance_from_home_km, n as user_7day_transaction_count, is_new_device,
    age as beneficiary_account_age_days, minutes as time_since_last_login_minutes, risky as is_high_risk_country"""

_CONSTRAINTS = {
    # (table, check, column): expression that counts violations
    ("users", "unique", "email"): "(select count(email) - count(distinct email) from u)",
    ("users", "unique", "phone"): "(select count(phone) - count(distinct phone) from u)",
    ("users", "primary_key", "user_id"): "(select count(*) - count(distinct user_id) from u)",
    ("users", "not_null", "kyc_status"): "(select count(*) from u where kyc_status is null)",
    ("transactions", "foreign_key", "user_id"): "(select count(*) from t where user_id not in (select user_id from u))",
    ("transactions", "foreign_key", "beneficiary_id"): "(select count(*) from t"
    " where beneficiary_id not in (select beneficiary_id from b))",
    ("device_authentications", "foreign_key", "user_id"): "(select count(*) from l"
    " where user_id not in (select user_id from u))",
}
# Declared constraints, by table. None of the derived tables breaks those not listed above.
_DECLARED = {
    "users": {
        "not_null": "user_id full_name email phone wallet_balance created_at kyc_status is_active",
        "check": "kyc_status risk_tier",
        "length": "full_name email phone home_city home_country kyc_status risk_tier",
        "primary_key": "user_id",
        "unique": "email phone",
    },
    "beneficiaries": {
        "not_null": "beneficiary_id beneficiary_name beneficiary_bank_account beneficiary_bank_code"
        " beneficiary_country created_at is_verified is_mule_flagged",
        "length": "beneficiary_name beneficiary_phone beneficiary_bank_account beneficiary_bank_code beneficiary_country",
        "primary_key": "beneficiary_id",
    },
    "device_authentications": {
        "not_null": "auth_id user_id device_id login_timestamp is_proxy_vpn is_emulator",
        "length": "device_id ip_address ip_geolocation_country ip_geolocation_city os_type browser_fingerprint",
        "primary_key": "auth_id",
        "foreign_key": "user_id",
    },
    "transactions": {
        "not_null": "transaction_id user_id beneficiary_id amount timestamp status final_decision rule_flags"
        " is_ground_truth_fraud",
        "length": "channel merchant_country status final_decision reviewed_by",
        "range": "transaction_balance_ratio",
        "primary_key": "transaction_id",
        "foreign_key": "user_id beneficiary_id",
    },
}


def _constraints() -> str:
    lines = [
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name,"
        f" cast({_CONSTRAINTS.get((table, check, column), '0')} as bigint) as violations"
        for table, checks in _DECLARED.items()
        for check, columns in checks.items()
        for column in columns.split()
    ]
    return "\nunion all ".join(lines)


CHECKS = {
    name: _check(text)
    for name, text in {
        "feat_balance_ratio": "select t.transaction_id, cast(r.ratio as double) as transaction_balance_ratio"
        " from t left join ratio r using (transaction_id)",
        "feat_time_flags": "select transaction_id, is_off_hours, is_weekend from clock",
        "feat_beneficiary_age": "select transaction_id, age as beneficiary_account_age_days,"
        " is_new as is_beneficiary_new from profile",
        "feat_high_risk_country": "select transaction_id, risky as is_high_risk_country from profile",
        "feat_user_7d_count": "select transaction_id, n as user_7day_transaction_count from history",
        "feat_last_login_asof": "select transaction_id, login_timestamp, device_id from latest",
        "feat_distance_km": "select transaction_id, km as distance_from_home_km from access",
        "feat_new_device": "select transaction_id, is_new_device from access",
        "feat_login_recency": "select transaction_id, minutes as time_since_last_login_minutes from access",
        "feat_login_history_lag": """select auth_id, user_id, login_timestamp, cast(ip_latitude as double) as ip_latitude,
            cast(ip_longitude as double) as ip_longitude, prev_login_timestamp,
            cast(prev_ip_latitude as double) as prev_ip_latitude,
            cast(prev_ip_longitude as double) as prev_ip_longitude from login_history""",
        "feat_all": f"select transaction_id, cast(amount as double) as amount, {FEATURES} from feat",
        "clean_user_text": "select user_id, trim(full_name) as full_name, lower(trim(email)) as email from u",
        "clean_beneficiary_text": "select beneficiary_id, trim(beneficiary_name) as beneficiary_name,"
        " upper(trim(beneficiary_bank_code)) as beneficiary_bank_code from b",
        "clean_phone_users": f"select user_id, {_phone('trim(phone)')} as phone from u",
        "clean_phone_beneficiaries": f"select beneficiary_id, {_phone('beneficiary_phone')} as beneficiary_phone from b",
        "clean_orphans": """select transaction_id, user_id, beneficiary_id from t
            where not (user_id not in (select user_id from u)
                       or beneficiary_id not in (select beneficiary_id from b))""",
        "clean_abs": """select 'transactions' as source, transaction_id as id, abs(cast(amount as double)) as amount from t
            union all select 'users', user_id, abs(cast(wallet_balance as double)) from u""",
        "clean_score_clamp": """select transaction_id, case when fraud_score < 0 then 0.0 when fraud_score > 1 then 1.0
            else cast(fraud_score as double) end as fraud_score from t""",
        "clean_user_defaults": """select user_id, coalesce(home_country, 'Vietnam') as home_country,
            coalesce(kyc_status, 'pending') as kyc_status, abs(cast(wallet_balance as double)) as wallet_balance from u""",
        "clean_txn_defaults": """select transaction_id, coalesce(cast(ratio as double), 0.0) as transaction_balance_ratio,
            coalesce(km, 0.0) as distance_from_home_km, coalesce(n, 0) as user_7day_transaction_count,
            coalesce(is_new, false) as is_beneficiary_new, coalesce(is_off_hours, false) as is_off_hours,
            coalesce(is_weekend, false) as is_weekend, coalesce(is_new_device, false) as is_new_device,
            coalesce(risky, false) as is_high_risk_country from feat""",
        "clean_time_repair": """select t.transaction_id, case when u.created_at > t."timestamp"
            then u.created_at + interval '5' minute else t."timestamp" end as "timestamp"
            from t left join u on t.user_id = u.user_id""",
        "clean_rederive_new": "select transaction_id, age < 30 as is_beneficiary_new from profile",
        "clean_dedup": """select t.transaction_id, t.user_id, t.beneficiary_id, cast(t.amount as double) as amount,
            t."timestamp" from t where not exists (select 1 from t as o where o.user_id = t.user_id
            and o.beneficiary_id = t.beneficiary_id and o.amount = t.amount and o."timestamp" = t."timestamp"
            and o.transaction_id < t.transaction_id)""",
        "clean_all": f"""select transaction_id, user_id, beneficiary_id, cast(amount as double) as amount,
            ts as "timestamp", fraud_score, {FEATURES} from c""",
        "clean_report": """select '=== DATA CLEANING REPORT ===' as report_status, count(*) as cleaned_transactions,
            count(*) filter (where amount <= 0) as invalid_amounts_left,
            count(*) filter (where km is null) as null_distances_left,
            count(*) filter (where user_id not in (select user_id from u)) as orphan_txns_left from c""",
        "constraint_report": _constraints(),
        "rule_structuring": _rule("r1"),
        "rule_velocity": _rule("r2"),
        "rule_velocity_raw": """select a.transaction_id from t a join t as z on a.user_id = z.user_id
            and z."timestamp" between a."timestamp" - interval '5' minute and a."timestamp"
            group by a.transaction_id having count(*) > 3""",
        "rule_cross_border": _rule("r3"),
        "rule_evasion": _rule("r4"),
        "rule_impossible_travel": _rule("r5"),
        "rule_mule_network": _rule("r6"),
        "rule_flags_all": "select transaction_id, rule_flags from flags",
        "rule_trigger_counts": "select rule_name, count(*) as triggered_count from fired group by rule_name"
        " order by triggered_count desc, rule_name",
        "mart_fraud_summary": """select f.transaction_id, f.ts as "timestamp", f.user_id,
            cast(f.amount as double) as amount, f.is_off_hours, f.is_weekend, f.km as distance_from_home_km,
            cast(f.ratio as double) as transaction_balance_ratio, f.age as beneficiary_account_age_days, f.rule_flags,
            cast(case when f.k > 0 then 1 else 0 end as bigint) as is_flagged, f.k as triggered_rules_count,
            upper(trim(b.beneficiary_bank_code)) as beneficiary_bank_code, b.beneficiary_country
            from flags f left join b on f.beneficiary_id = b.beneficiary_id""",
        "mart_rule_breakdown": """select c.transaction_id, c.ts as "timestamp", cast(c.amount as double) as amount,
            x.rule_name, upper(trim(b.beneficiary_bank_code)) as beneficiary_bank_code
            from fired x join c using (transaction_id) left join b on c.beneficiary_id = b.beneficiary_id""",
        "mart_kpi_cards": f"""select count(*) as total_volume, count(*) filter (where k > 0) as flagged_txns,
            {_pct("count(*) filter (where k > 0)", "count(*)")} as fraud_rate from flags""",
        "mart_hourly_trend": "select hour(ts) as hour_of_day, count(*) as txns,"
        " count(*) filter (where k > 0) as flagged_txns from flags group by 1 order by 1",
        "mart_incidents": """select transaction_id, ts as "timestamp", user_id, cast(amount as double) as amount,
            rule_flags, beneficiary_id from flags where k > 0""",
        "mart_mule_beneficiaries": """select c.beneficiary_id, count(*) as mule_triggers,
            cast(extract(day from (max(c.ts) - max(b.created_at))) as bigint) as age_days
            from r6 join c using (transaction_id) join b on c.beneficiary_id = b.beneficiary_id
            group by c.beneficiary_id""",
        "rpt_velocity_off_hours": f"""select count(*) as total_velocity_triggered,
            count(*) filter (where is_off_hours) as off_hours_velocity_triggered,
            {_pct("count(*) filter (where is_off_hours)", "count(*)")} as off_hours_velocity_percentage
            from r2 join c using (transaction_id)""",
        "rpt_evasion_share": f"""select n as actual_evasion_transactions, total as total_flagged_anomalies,
            {_pct("n", "total")} as actual_percentage from (select (select count(*) from r4) as n,
            (select count(distinct transaction_id) from fired) as total)""",
        "rpt_remote_off_hours": f"""select count(*) as total_transactions,
            count(*) filter (where km > 100) as remote_transactions_gt_100km,
            count(*) filter (where km > 100 and is_off_hours) as remote_and_offhours,
            {_pct("count(*) filter (where km > 100 and is_off_hours)", "count(*) filter (where km > 100)")}
            as overlap_percentage from c""",
        "rpt_exec_metrics": """select n as total_transactions, hits as flagged_transactions,
            cast(money as double) as total_amount, cast(risk as double) as amount_at_risk,
            round(case when n > 0 then cast(hits as double) / n else 0 end, 6) as flag_rate,
            round(case when money > 0 then cast(risk as double) / cast(money as double) else 0 end, 6) as amount_share
            from totals""",
        "rpt_exec_rows": """select cast(line as bigint) as line, label, value from (
            select *, format('{:,}', cast(round(money) as bigint)) || ' VND' as money_text,
                format('{:,}', cast(round(risk) as bigint)) || ' VND' as risk_text,
                format('{:.1f}', round(case when n > 0 then 100.0 * hits / n else 0 end, 1)) || '%' as rate_text,
                format('{:.1f}', round(case when money > 0 then cast(100.0 as double) * cast(risk as double)
                    / cast(money as double) else 0 end, 1)) || '%' as share_text from totals) x,
            lateral (values (1, 'Total Transactions', format('{:,}', n)),
                (2, 'Flagged Transactions', format('{:,}', hits)), (3, 'Flag Rate (by count)', rate_text),
                (4, 'Total Transaction Volume', money_text), (5, 'Amount at Risk (flagged)', risk_text),
                (6, 'Share of Total Volume', share_text), (7, 'Banner', 'FLAGGED TRANSACTION REPORT'),
                (8, 'Banner', 'Total: ' || n || '   |   Flagged: ' || hits || '   |   Flag Rate: ' || rate_text),
                (9, 'Banner', 'Amount at Risk: ' || risk_text || '   |   Share of Total Volume: ' || share_text)
            ) v(line, label, value)""",
        "rpt_top10": """select row_number() over (order by amount desc, transaction_id) as rank, transaction_id,
            ts as "timestamp", amount from p where flag and amount >= 0 order by 1 limit 10""",
        "port_clean": """select transaction_id, user_id, beneficiary_id, amount, ts as "timestamp", phone_number,
            is_new as is_beneficiary_new from p""",
        "port_repair_counts": """select *, rows_before - duplicates_removed - orphans_purged as rows_after from (
            select (select count(*) from flat) as rows_before,
            (select count(*) from flat where amount < 0) as amounts_corrected,
            (select count(*) from flat where is_new is null) as flags_imputed,
            (select count(*) from pieces where rn > 1) as duplicates_removed,
            (select count(*) from pieces where rn = 1 and (user_id is null or beneficiary_id is null)) as orphans_purged)""",
        "port_distance": "select transaction_id, round(km, 2) as distance_from_home_km from p",
        "port_time_flags": "select transaction_id, is_off_hours, is_weekend from p",
        "port_evasion_flag": "select transaction_id, flag as biometric_evasion_flag from p",
        "port_flag_rate": "select hits as flagged_count, round(cast(hits as double) / n * 100, 2) as flag_rate from totals",
        "port_quality_report": """select 'cleaned_transactions' as metric, count(*) as metric_value from p
            union all select 'invalid_amounts_left', count(*) from p where amount < 0
            union all select 'null_distances_left', count(*) from p where km is null
            union all select 'orphan_txns_left', count(*) from p where user_id is null or beneficiary_id is null
            union all select 'duplicate_txns_left', (select count(*) from p) - (select count(*) from (
                select distinct user_id, beneficiary_id, amount, ts from p))""",
        "port_distance_summary": """select name, round(value, 2) as value from (
            select 'count' as name, cast(count(km) as double) as value from p
            union all select 'mean', avg(km) from p union all select 'std', stddev_samp(km) from p
            union all select 'min', min(km) from p union all select '25%', quantile_cont(km, 0.25) from p
            union all select '50%', quantile_cont(km, 0.5) from p union all select '75%', quantile_cont(km, 0.75) from p
            union all select 'max', max(km) from p)""",
        "prim_semi_in": f"""select transaction_id, beneficiary_id from t where beneficiary_id in (
            select beneficiary_id from b where beneficiary_country in {RISKY})""",
        "prim_anti_not_in": "select transaction_id, user_id from t where user_id not in (select user_id from u)",
        "prim_exists": """select transaction_id from t where exists (select 1 from l where l.user_id = t.user_id
            and l.login_timestamp <= t."timestamp")""",
        "prim_union_append": """select transaction_id, cast(amount as double) as amount from t
            union all select transaction_id, -cast(amount as double) from t where amount < 0""",
        "prim_array_any": "select transaction_id, transaction_id in (select transaction_id from r4) as evading from c",
        "prim_unnest": "select transaction_id, rule_name from fired",
        "prim_having_distinct": """select beneficiary_id, count(distinct user_id) as senders from t
            group by beneficiary_id having count(distinct user_id) >= 4""",
        "prim_filtered_counts": """select count(*) as total, count(*) filter (where amount < 0) as negative,
            count(*) filter (where amount between 9000000 and 9999999) as in_band,
            count(*) filter (where amount >= 10000000) as large from t""",
        "prim_interval_self_join": """select a.transaction_id from t a join t as z on a.beneficiary_id = z.beneficiary_id
            and z."timestamp" between a."timestamp" - interval '1' hour and a."timestamp"
            group by a.transaction_id having count(distinct z.user_id) >= 4""",
        "prim_describe_amount": """select name, round(value, 2) as value from (
            select 'count' as name, cast(count(amount) as double) as value from t
            union all select 'mean', avg(cast(amount as double)) from t
            union all select 'std', stddev_samp(cast(amount as double)) from t
            union all select 'min', min(cast(amount as double)) from t
            union all select '25%', quantile_cont(cast(amount as double), 0.25) from t
            union all select '50%', quantile_cont(cast(amount as double), 0.5) from t
            union all select '75%', quantile_cont(cast(amount as double), 0.75) from t
            union all select 'max', max(cast(amount as double)) from t)""",
        "io_csv_roundtrip": """select transaction_id, cast(user_id as varchar) as user_id,
            cast(beneficiary_id as varchar) as beneficiary_id, cast(amount as double) as amount, "timestamp",
            'MOBILE_APP' as channel, merchant_country, 'pending' as status, cast(fraud_score as double) as fraud_score,
            'pending' as final_decision, is_ground_truth_fraud from t""",
        "clean_repair_counts": """select *, rows_before - orphans_purged - rows_after as copies_removed from (
            select count(*) as rows_before, count(*) filter (where not ok) as orphans_purged,
            count(*) filter (where ok and amount < 0) as amounts_made_positive,
            count(*) filter (where ok and (fraud_score < 0 or fraud_score > 1)) as scores_clamped,
            count(*) filter (where ok and (ratio is null or km is null or n is null or is_new is null
                or is_off_hours is null or is_weekend is null or is_new_device is null or risky is null))
                as rows_with_defaults,
            count(*) filter (where ok and "timestamp" < created_at) as times_moved, (select count(*) from c) as rows_after
            from (select f.*, u.created_at, u.user_id is not null and b.beneficiary_id is not null as ok
                from feat f left join u on f.user_id = u.user_id left join b on f.beneficiary_id = b.beneficiary_id))""",
        "mart_preview_rows": """select * from (values ('features', least(5, (select count(*) from c)), 0),
            ('mart', least(5, (select count(*) from c)), 0),
            ('portable', least(5, (select count(*) from p where flag)), 0), ('sample', -1, 0)) v(preview, rows, strangers)""",
        "io_append_defaults": """select full_name, email, phone, 0.0::double as wallet_balance, 'Vietnam' as home_country,
            'pending' as kyc_status, 'low' as risk_tier, true as is_active, count(*) * 2 as copies,
            (select count(*) * 2 from u) as new_ids from u group by full_name, email, phone""",
        "io_staged_run": "select transaction_id, rule_flags from flags",
        "sql_views": """select x.rule_name, count(*) as triggers, count(distinct c.user_id) as users, count(*) as flagged
            from fired x join c using (transaction_id) group by x.rule_name""",
        "param_velocity_cross_border": """select 'velocity_rule' as rule_name, count(*) as triggered_count from (
                select count(*) over (partition by user_id order by ts
                range between interval '5' minute preceding and current row) as k from c) where k > 1
            union all select 'cross_border_fraud_rule', count(*) from c
                where merchant_country in ('Iran', 'Russia') and amount > 100000""",
        "io_report_csv": "select transaction_id, amount from p where flag",
        "io_parquet_marts": """select f.transaction_id, cast(f.amount as double) as amount,
            f.k as triggered_rules_count, upper(trim(b.beneficiary_bank_code)) as beneficiary_bank_code
            from flags f left join b on f.beneficiary_id = b.beneficiary_id""",
    }.items()
}
CHECKS |= {f"{name}_hot": CHECKS[name] for name in ("feat_all", "feat_login_history_lag", "rule_flags_all")}
_DRAW = "md5(cast({id} as varchar) || ':{seed}')"
CHECKS |= {
    "feat_preview": f"{CHECKS['feat_all']} order by {_DRAW.format(id='transaction_id', seed=7)} limit 5",
    "mart_preview": f"{CHECKS['mart_fraud_summary']} order by {_DRAW.format(id='f.transaction_id', seed=7)} limit 5",
    "port_flagged_preview": _check(f"""select transaction_id, amount, is_new as is_beneficiary_new, ts as "timestamp"
        from p where flag order by {_DRAW.format(id='transaction_id', seed=7)} limit 5"""),
    "prim_sample": _check(f"""select transaction_id, user_id, beneficiary_id, cast(amount as double) as amount, "timestamp"
        from t where {_DRAW.format(id='transaction_id', seed=1)} < '{int(0.03 * 2**32):08x}'"""),
    "rule_mule_senders": _check("""select a.transaction_id, array_to_string(list_sort(list(distinct z.user_id)), '|') as senders
        from t a join t as z on a.beneficiary_id = z.beneficiary_id
        and z."timestamp" between a."timestamp" - interval '1' hour and a."timestamp"
        group by a.transaction_id having count(distinct z.user_id) >= 4"""),
}


def _violations(table: str, check: str, column: str, key: str, rows: str) -> str:
    return f"""select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name,
        cast({key} as varchar) as row_key, cast(1 as bigint) as copies from {rows}"""


def _repeated(part: str, column: str, key: str) -> str:
    return f"""(select {key}, row_number() over (partition by {column} order by {key}) as rn from {part}
        where {column} is not null) where rn > 1"""


_BAD = "transaction_id // 100 % {} = 0"
CHECKS |= {
    "constraint_rows": _check("\nunion all ".join([
        _violations("users", "not_null", "kyc_status", "user_id", "u where kyc_status is null"),
        _violations("users", "unique", "email", "user_id", _repeated("u", "email", "user_id")),
        _violations("users", "unique", "phone", "user_id", _repeated("u", "phone", "user_id")),
        _violations("users", "primary_key", "user_id", "user_id", _repeated("u", "user_id", "user_id")),
        _violations("transactions", "foreign_key", "user_id", "transaction_id", "t where user_id not in (select user_id from u)"),
        _violations("transactions", "foreign_key", "beneficiary_id", "transaction_id",
                    "t where beneficiary_id not in (select beneficiary_id from b)"),
        _violations("device_authentications", "foreign_key", "user_id", "auth_id", "l where user_id not in (select user_id from u)"),
    ])),
    "io_csv_good_rows": _check(f"""select cast(transaction_id as varchar) as transaction_id, cast(user_id as varchar) as user_id,
        cast(beneficiary_id as varchar) as beneficiary_id, cast(amount as double) as amount, "timestamp",
        'MOBILE_APP' as channel, 'pending' as status from t
        where not ({_BAD.format(31)} or {_BAD.format(37)} or {_BAD.format(41)})"""),
    "io_csv_rejected_rows": _check(f"""select cast(transaction_id as varchar) as transaction_id, concat_ws('|',
            case when {_BAD.format(41)} then 'wrong number of values' end,
            case when {_BAD.format(31)} then 'amount is not a decimal(15,2)' end,
            case when {_BAD.format(37)} then 'timestamp is not a timestamp_ntz' end) as reasons from t
        where {_BAD.format(31)} or {_BAD.format(37)} or {_BAD.format(41)}"""),
}
CHECKS["rule_mule_senders_hot"] = CHECKS["rule_mule_senders"]
CHECKS |= {
    "stream_velocity": _check("""select a.transaction_id, count(*) as transfers from t a join t as z on a.user_id = z.user_id
        and z."timestamp" between a."timestamp" - interval '5' minute and a."timestamp"
        group by a.transaction_id having count(*) > 3"""),
    "stream_mules": _check("""select a.transaction_id, count(distinct z.user_id) as senders
        from t a join t as z on a.beneficiary_id = z.beneficiary_id
        and z."timestamp" between a."timestamp" - interval '1' hour and a."timestamp"
        group by a.transaction_id having count(distinct z.user_id) >= 4"""),
    "stream_last_login": CHECKS["feat_last_login_asof"],
    "stream_first_arrivals": CHECKS["clean_dedup"],
    "stream_smallest_ids": CHECKS["clean_dedup"],
    "stream_rule_breakdown": CHECKS["mart_rule_breakdown"],
    "feat_all_laid_out": CHECKS["feat_all"],
    "inc_three_loads": CHECKS["rule_flags_all"],
    "inc_three_loads_features": CHECKS["clean_all"],
}
