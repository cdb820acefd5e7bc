"""DuckDB twins of the registered queries, written independently of the Spark code.

Results use plain types only: integers, doubles, text (dates as ISO text) and booleans.
"""

from __future__ import annotations

from tamarind.functions.text import ABBREVIATIONS
from tamarind.sources.html import ENTITIES

VIEWS = {
    "customer_transaction": """
        select o_custkey as customer_id, cast(o_orderdate as date) as purchase_date,
               cast(o_totalprice as decimal(18,2)) as gmv from orders""",
    "customer_registered": """
        select c_custkey as customer_id, date '1996-01-01' + cast(c_custkey * 7 % 2050 as int) as created_date,
               case when c_acctbal < 0 then date '1996-01-01' + cast(c_custkey * 7 % 2050 + 900 as int) end as stop_date
        from customer where c_mktsegment <> 'MACHINERY'""",
    "sales": """
        select o_custkey as customer_id, cast(o_orderdate as date) as order_date, l_partkey as product_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "menu": """
        select p_partkey as product_id, p_name as product_name, cast(p_retailprice as decimal(18,2)) as price from part""",
    "members": """
        select c_custkey as customer_id, date '1997-01-01' + cast(c_custkey % 1000 as int) as join_date
        from customer where c_acctbal >= 1000""",
    "employee_statement": """
        select o_orderkey as statement_id,
               case o_orderstatus when 'F' then 'TERMINATED' when 'O' then 'HIRED' else 'OTHER' end as statement_type,
               o_orderpriority as statement_name, cast(o_orderdate as date) as statement_valid_date,
               case when o_orderkey % 97 <> 0
                    then cast(o_orderdate as date) - cast(o_orderkey % 3000 - 100 as int) end as employee_work_date,
               n_name as work_location,
               case c_mktsegment when 'BUILDING' then 'Senior Specialist' when 'MACHINERY' then 'Head of Unit'
                    when 'HOUSEHOLD' then 'Collaborator (part time)' when 'AUTOMOBILE' then 'Managing Director' end as job_title,
               case when o_custkey % 7 <> 0 then 'L' || cast(o_custkey % 40 as varchar) end as leader_code
        from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""",
    "statements": """
        select statement_id, statement_type, statement_name, statement_valid_date, employee_work_date, work_location,
               job_title, coalesce(leader_code, 'No Leader') as leader_code,
               case when job_title like '%Specialist%' then 'Specialist' when job_title like '%Head of Unit%' then 'Head of Unit'
                    when job_title like '%Collaborator%' then 'Collaborator' when job_title like '%Director%' then 'Director'
               end as position,
               round_even(cast((case when statement_type = 'TERMINATED' then statement_valid_date else date '2001-09-01' end)
                    - employee_work_date as double) / 365, 0) + 0.0 as tenure,
               cast(year(statement_valid_date) as int) as valid_year, cast(month(statement_valid_date) as int) as valid_month
        from employee_statement where employee_work_date is not null""",
    "leavers": "select * from statements where statement_type = 'TERMINATED'",
    "launch": """
        select l_orderkey as launch_id, l_linenumber as launch_seq, l_partkey as part_key, l_suppkey as supp_key,
               cast(l_shipdate as date) as launch_date, case when l_partkey % 20 <> 0 then l_quantity end as payload_mass,
               p_type as orbit, p_brand as booster_version, 'SITE_' || cast(s_nationkey % 4 as varchar) as launch_site,
               l_returnflag || ' ' || l_linestatus as outcome,
               case when l_returnflag || l_linestatus in ('RF', 'NF') then 0 else 1 end as class
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "baskets": """
        select distinct l_orderkey as transaction_id, p_name as item from lineitem join part on l_partkey = p_partkey""",
    "site_geo": """
        select s_suppkey as site_id, s_name as site_name, cast(s_suppkey * 37 % 1800 as double) / 10 - 90 as lat,
               cast(s_suppkey * 73 % 3600 as double) / 10 - 180 as lon from supplier""",
    "poi_geo": """
        select cast(n_nationkey as bigint) as poi_id, n_name as poi_name,
               cast(n_nationkey * 211 % 1800 as double) / 10 - 90 as poi_lat,
               cast(n_nationkey * 389 % 3600 as double) / 10 - 180 as poi_lon from nation""",
    "launch_points": """
        select launch_id, launch_seq, part_key, supp_key, site_name, lat, lon, class
        from launch join site_geo on supp_key = site_id""",
    "rfm": """
        select t.customer_id, cast(date '2001-09-01' - max(purchase_date) as int) as recency,
               cast(count(distinct purchase_date) as double)
                 / nullif(floor((date '2001-09-01' - created_date) / 365.25), 0) as frequency,
               cast(sum(gmv) as double)
                 / nullif(floor((coalesce(stop_date, date '2001-09-01') - created_date) / 365.25), 0) as monetary
        from customer_transaction t join customer_registered r on t.customer_id = r.customer_id
        where t.customer_id <> 0 group by t.customer_id, created_date, stop_date""",
    "rfm_ranked": """
        select customer_id, row_number() over (order by recency desc nulls last, customer_id) as rr,
               row_number() over (order by frequency asc nulls first, customer_id) as rf,
               row_number() over (order by monetary asc nulls first, customer_id) as rm, (select count(*) from rfm) as n
        from rfm""",
    "rfm_scored": """
        select customer_id,
               case when rr * 5 <= n then 1 when rr * 5 <= 2 * n then 2 when rr * 5 <= 3 * n then 3
                    when rr * 5 <= 4 * n then 4 else 5 end as recency_score,
               case when rf * 5 <= n then 1 when rf * 5 <= 2 * n then 2 when rf * 5 <= 3 * n then 3
                    when rf * 5 <= 4 * n then 4 else 5 end as frequency_score,
               case when rm * 5 <= n then 1 when rm * 5 <= 2 * n then 2 when rm * 5 <= 3 * n then 3
                    when rm * 5 <= 4 * n then 4 else 5 end as monetary_score
        from rfm_ranked""",
    "launch_document": """
        select o_orderkey as flight_number, cast(o_orderdate as date) as launch_date,
               'R' || cast(o_custkey % 4 as varchar) as rocket, 'P' || cast(o_orderkey as varchar) as payload_id,
               'B' || cast(o_custkey as varchar) as core_id,
               case o_orderstatus when 'F' then 'True' when 'O' then 'False' else 'None' end as landed,
               case when o_orderstatus = 'P' then 'None' when o_custkey % 2 = 0 then 'ASDS' else 'RTLS' end as landing,
               cast(o_orderkey % 9 + 1 as int) as flights, o_orderkey % 2 = 0 as grid_fins, o_orderkey % 3 = 0 as reused,
               o_orderkey % 4 <> 0 as legs,
               case when o_custkey % 4 = 0 then 'pad' || cast(o_custkey % 5 as varchar) end as landing_pad
        from orders
        where o_orderkey % 3 = 1 and o_custkey % 3 = 1 and cast(o_orderdate as date) <= date '2000-11-13'""",
    "revenue_rows": """
        select o_orderkey as row_id, cast(o_orderdate as date) as d, floor(o_totalprice) as revenue
        from orders where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0""",
    "split": """
        select vec_id, label, embedding,
               cast('0x' || substr(md5('2:' || cast(vec_id as varchar)), 1, 8) as bigint) % 1000 < 200 as is_test
        from embeddings""",
    "entries": """
        select vec_id, label, is_test, generate_subscripts(embedding, 1) as e, cast(unnest(embedding) as double) as x
        from split""",
    "distances": """
        select a.vec_id as id, b.vec_id as neighbour, any_value(a.label) as label, any_value(b.label) as vote,
               sum(abs(a.x - b.x)) as d1, sum((a.x - b.x) * (a.x - b.x)) as d2
        from entries a join entries b on a.e = b.e where a.is_test and not b.is_test group by a.vec_id, b.vec_id""",
    "places": """
        select id, label, vote, 1 as p, row_number() over (partition by id order by d1, neighbour) as place from distances
        union all
        select id, label, vote, 2 as p, row_number() over (partition by id order by d2, neighbour) as place from distances""",
    "fold_entries": """
        select vec_id, label, cast('0x' || substr(md5('3:' || cast(vec_id as varchar)), 1, 8) as bigint) % 10 as fold, e, x
        from entries where not is_test""",
    "fold_distances": """
        select a.vec_id as id, b.vec_id as neighbour, any_value(a.fold) as fold, any_value(a.label) as label,
               any_value(b.label) as vote, sum(abs(a.x - b.x)) as d1, sum((a.x - b.x) * (a.x - b.x)) as d2
        from fold_entries a join fold_entries b on a.e = b.e where a.fold <> b.fold group by a.vec_id, b.vec_id""",
    "fold_places": """
        select id, fold, label, vote, 1 as p, row_number() over (partition by id order by d1, neighbour) as place
        from fold_distances
        union all
        select id, fold, label, vote, 2 as p, row_number() over (partition by id order by d2, neighbour) as place
        from fold_distances""",
    "votes": """
        select id, any_value(label) as label, p, cast(k as int) as k, vote, count(*) as n
        from places cross join range(1, 11) t(k) where place <= k group by id, p, k, vote""",
    "predictions": """
        select id, p, k, label, vote as predicted from votes
        qualify row_number() over (partition by id, p, k order by n desc, vote) = 1""",
}

# What each view reads, so that a query only carries the views it needs.
_DEPENDS = {
    "statements": ["employee_statement"],
    "leavers": ["statements"],
    "launch_points": ["launch", "site_geo"],
    "rfm": ["customer_transaction", "customer_registered"],
    "rfm_ranked": ["rfm"],
    "rfm_scored": ["rfm_ranked"],
    "entries": ["split"],
    "distances": ["entries"],
    "places": ["distances"],
    "fold_entries": ["entries"],
    "fold_distances": ["fold_entries"],
    "fold_places": ["fold_distances"],
    "votes": ["places"],
    "predictions": ["votes"],
}


def _with(body: str, *views: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _DEPENDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    clause = ",\n".join(f"{name} as ({VIEWS[name]})" for name in order)
    return f"with {clause}\n{body}" if order else body


_FIRST_LAST = """
    select customer_id, {day} string_agg(distinct product_name, ', ' order by product_name) as product_name
    from (select s.customer_id, order_date, product_name,
                 dense_rank() over (partition by s.customer_id order by order_date {direction}) as r
          from sales s left join menu u on s.product_id = u.product_id {members})
    where r = 1 group by customer_id, order_date"""
_MEMBER_SALES = "sales s join members m on s.customer_id = m.customer_id left join menu u on s.product_id = u.product_id"
_SHARE = """
    select {key}, cast(count({counted}) as bigint) as total_employees,
           round_even(cast(count({counted}) as double) / (sum(count({counted})) over ()) * 100, 2) as share_pct
    from {source} where {key} is not null {more} group by {key}"""
_COUNT = """
    select {keys}, count({counted}) as total_employees from {source} where {where} group by {keys}"""
_CLEAN = (
    "trim(regexp_replace({0}, '[\\s\\v\\x{{85}}\\p{{Z}}]+', ' ', 'g'))"
)
_PLAIN = (
    "translate(regexp_replace(lower(text), '[?!.]+[\\s\\v\\x{85}\\p{Z}]*$', ''), ',.;“:”\"''!?-\\)(@', '               ')"
)


def _abbreviations(text: str) -> str:
    for pattern, replacement in ABBREVIATIONS:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


_KM = """2 * 6373.0 * atan2(sqrt(h), sqrt(1 - h))"""
_HAVERSINE = """
    power(sin((radians(poi_lat) - radians(lat)) / 2), 2)
    + cos(radians(lat)) * cos(radians(poi_lat)) * power(sin((radians(poi_lon) - radians(lon)) / 2), 2)"""

_PROFILE = """
    select '{c}' as column_name, '{t}' as data_type, count(*) as row_count,
           count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as n_distinct,
           count(*) - count({c}) as null_count,
           case when count(distinct {c}) + max(case when {c} is null then 1 else 0 end) < {most}
                then string_agg(distinct cast({c} as varchar), '|' order by cast({c} as varchar)) end as value_list
    from employee_statement"""
_STATEMENT_COLUMNS = (
    ("statement_id", "bigint"), ("statement_type", "string"), ("statement_name", "string"), ("statement_valid_date", "date"),
    ("employee_work_date", "date"), ("work_location", "string"), ("job_title", "string"), ("leader_code", "string"),
)
_MESSY = """
    select statement_id, statement_type, strftime(statement_valid_date, '%m/%d/%Y') as statement_valid_date,
           case when statement_id % 5 = 0 then '12/31/9999' else strftime(statement_valid_date + 365, '%m/%d/%Y') end
               as statement_expired_date,
           strftime(employee_work_date, '%m/%d/%Y') as employee_work_date, work_location, job_title, leader_code as KH200,
           'E' || cast(statement_id as varchar) as employee_code
    from employee_statement"""
_DAY_TEXTS = """
    select o_orderkey, o_orderpriority,
           case when o_orderpriority[1] in ('2', '5') then strftime(o_orderdate, '%m/%d/%Y')
                else strftime(o_orderdate, '%d/%m/%Y') end as day_text
    from orders"""
_LINKS = "regexp_extract_all(regexp_extract(html, '(?is)<ul(?:\\s[^>]*)?>(.*?)</ul\\s*>', 1), '(?is)<li(?:\\s[^>]*)?>(.*?)</li\\s*>', 1)"


def _text_of(html: str) -> str:
    text = f"regexp_replace({html}, '(?s)<[^>]*>', '', 'g')"
    for entity, sign in ENTITIES:
        sign = sign.replace("'", "''")
        text = f"replace({text}, '{entity}', '{sign}')"
    return f"regexp_replace({text}, '^[\\s\\v\\p{{Z}}]+|[\\s\\v\\p{{Z}}]+$', '', 'g')"


_BEST = "case when w0 >= w1 and w0 >= w2 then 0 when w1 >= w2 then 1 else 2 end"
VIEWS |= {
    "comment_words": f"""
        select doc_id, unnest(string_split({_CLEAN.format(_abbreviations(_PLAIN))}, ' ')) as word from documents
        where text is not null""",
    "comment_labels": """
        select doc_id, case when toxic = 1 then 0 when quality = 1 then 1 else 2 end as label
        from labels join documents using (doc_id) where text is not null""",
    "comment_counts": """
        select word, count(*) filter (label = 0) as n0, count(*) filter (label = 1) as n1, count(*) filter (label = 2) as n2
        from comment_words join comment_labels using (doc_id) where word <> '' group by word""",
    "comment_weights": """
        select word, ln((n0 + 1.0::double) / (sum(n0) over () + count(*) over ())) as w0,
               ln((n1 + 1.0::double) / (sum(n1) over () + count(*) over ())) as w1,
               ln((n2 + 1.0::double) / (sum(n2) over () + count(*) over ())) as w2 from comment_counts""",
    "comment_priors": """
        select ln((count(*) filter (label = 0) + 1.0::double) / (count(*) + 3)) as p0,
               ln((count(*) filter (label = 1) + 1.0::double) / (count(*) + 3)) as p1,
               ln((count(*) filter (label = 2) + 1.0::double) / (count(*) + 3)) as p2 from comment_labels""",
    "comment_scores": """
        select doc_id, round(sum(w0) + any_value(p0), 6) as w0, round(sum(w1) + any_value(p1), 6) as w1,
               round(sum(w2) + any_value(p2), 6) as w2
        from comment_words join comment_weights using (word), comment_priors group by doc_id""",
}
VIEWS["fold_scores"] = """
    select p, k, round(avg(score), 9) as cv_accuracy
    from (select p, k, fold, avg(case when label = vote then 1.0::double else 0 end) as score
          from (select * from (select id, fold, any_value(label) as label, p, cast(k as int) as k, vote, count(*) as n
                               from fold_places cross join range(1, 11) t(k) where place <= k
                               group by id, fold, p, k, vote)
                qualify row_number() over (partition by id, p, k order by n desc, vote) = 1)
          group by p, k, fold)
    group by p, k"""
_DEPENDS |= {
    "fold_scores": ["fold_places"],
    "comment_counts": ["comment_words", "comment_labels"],
    "comment_weights": ["comment_counts"],
    "comment_priors": ["comment_labels"],
    "comment_scores": ["comment_weights", "comment_priors"],
}

ORACLE_SQL: dict[str, str] = {
    "rfm_metrics": _with("select * from rfm", "rfm"),
    "rfm_scores": _with(
        """select *, cast(recency_score as varchar) || cast(frequency_score as varchar)
               || cast(monetary_score as varchar) as rfm_score from rfm_scored""",
        "rfm_scored",
    ),
    "rfm_distribution": _with(
        """select cast(recency_score as varchar) || cast(frequency_score as varchar)
               || cast(monetary_score as varchar) as rfm_score, count(distinct customer_id) as total_customers
           from rfm_scored group by 1 order by 2 desc, 1""",
        "rfm_scored",
    ),
    "global_rank": """
        select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as row_no from orders""",
    "loyalty_total_spent": _with(
        """select customer_id, cast(sum(price) as double) as total_spent
           from sales s left join menu u on s.product_id = u.product_id group by customer_id order by 2 desc, 1""",
        "sales", "menu",
    ),
    "loyalty_visit_days": _with(
        "select customer_id, count(distinct order_date) as total_days from sales group by customer_id", "sales"
    ),
    "loyalty_first_item": _with(_FIRST_LAST.format(day="", direction="asc", members=""), "sales", "menu"),
    "loyalty_top_item": _with(
        """select product_name, count(*) as total_orders from sales s left join menu u on s.product_id = u.product_id
           group by product_name order by 2 desc, 1 limit 1""",
        "sales", "menu",
    ),
    "loyalty_favourite_item": _with(
        """select customer_id, product_name, total_orders
           from (select customer_id, product_name, count(*) as total_orders,
                        dense_rank() over (partition by customer_id order by count(*) desc) as r
                 from sales s left join menu u on s.product_id = u.product_id group by customer_id, product_name)
           where r = 1""",
        "sales", "menu",
    ),
    "loyalty_first_after_join": _with(
        f"""select customer_id, product_name, cast(order_date as varchar) as order_date
            from (select s.customer_id, product_name, order_date,
                         dense_rank() over (partition by s.customer_id order by order_date) as r
                  from {_MEMBER_SALES} where order_date >= join_date)
            where r = 1""",
        "sales", "menu", "members",
    ),
    "loyalty_before_join_ref": _with(
        _FIRST_LAST.format(
            day="cast(order_date as varchar) as order_date,", direction="asc",
            members="join members m on s.customer_id = m.customer_id where order_date < join_date",
        ),
        "sales", "menu", "members",
    ),
    "loyalty_last_before_join": _with(
        _FIRST_LAST.format(
            day="cast(order_date as varchar) as order_date,", direction="desc",
            members="join members m on s.customer_id = m.customer_id where order_date < join_date",
        ),
        "sales", "menu", "members",
    ),
    "loyalty_pre_member_totals": _with(
        f"""select s.customer_id, count(*) as total_items, cast(sum(price) as double) as amount_spent
            from {_MEMBER_SALES} where order_date < join_date group by s.customer_id order by 1""",
        "sales", "menu", "members",
    ),
    "loyalty_points": _with(
        """select customer_id,
                  cast(sum(case when product_name = 'red plate' then price * 20 else price * 10 end) as double) as customer_points
           from sales s left join menu u on s.product_id = u.product_id group by customer_id order by 1""",
        "sales", "menu",
    ),
    "loyalty_member_month_sales": _with(
        f"""select s.customer_id, cast(order_date as varchar) as order_date, s.product_id, product_name,
                   cast(price as double) as price, cast(join_date as varchar) as join_date
            from {_MEMBER_SALES} where order_date >= join_date and month(order_date) = 1""",
        "sales", "menu", "members",
    ),
    "loyalty_points_first_week": _with(
        f"""select s.customer_id,
                   cast(sum(case when order_date between join_date and join_date + 6 then price * 20
                                 when product_name = 'red plate' then price * 20 else price * 10 end) as double)
                       as customer_points
            from {_MEMBER_SALES} where order_date <= date '2001-01-31' and order_date >= join_date
            group by s.customer_id order by 1""",
        "sales", "menu", "members",
    ),
    "loyalty_member_flag": _with(
        """select s.customer_id, cast(order_date as varchar) as order_date, product_name, cast(price as double) as price,
                  case when order_date >= join_date then 'Y' else 'N' end as member
           from sales s left join members m on s.customer_id = m.customer_id left join menu u on s.product_id = u.product_id""",
        "sales", "menu", "members",
    ),
    "loyalty_member_ranking": _with(
        """select customer_id, cast(order_date as varchar) as order_date, product_name, price, member,
                  cast(case when member = 'Y' then dense_rank() over (partition by customer_id, member order by order_date)
                       end as int) as ranking
           from (select s.customer_id, order_date, product_name, cast(price as double) as price,
                        case when order_date >= join_date then 'Y' else 'N' end as member
                 from sales s left join members m on s.customer_id = m.customer_id
                 left join menu u on s.product_id = u.product_id)""",
        "sales", "menu", "members",
    ),
    "basket_pairs": _with(
        """select a.item as item_a, b.item as item_b, count(*) as pair_count, cast(count(*) as double) / any_value(n) as support,
                  cast(count(*) as double) / any_value(x.c) as confidence_ab,
                  cast(count(*) as double) / any_value(y.c) as confidence_ba,
                  cast(count(*) * any_value(n) as double) / (any_value(x.c) * any_value(y.c)) as lift
           from baskets a join baskets b on a.transaction_id = b.transaction_id and a.item < b.item
           join (select item, count(*) as c from baskets group by item) x on x.item = a.item
           join (select item, count(*) as c from baskets group by item) y on y.item = b.item
           cross join (select count(distinct transaction_id) as n from baskets)
           group by a.item, b.item""",
        "baskets",
    ),
    "basket_pairs_supported": _with(
        """select * from (
               select a.item as item_a, b.item as item_b, count(*) as pair_count,
                      cast(count(*) as double) / any_value(n) as support,
                      cast(count(*) as double) / any_value(x.c) as confidence_ab,
                      cast(count(*) as double) / any_value(y.c) as confidence_ba,
                      cast(count(*) * any_value(n) as double) / (any_value(x.c) * any_value(y.c)) as lift
               from baskets a join baskets b on a.transaction_id = b.transaction_id and a.item < b.item
               join (select item, count(*) as c from baskets group by item) x on x.item = a.item
               join (select item, count(*) as c from baskets group by item) y on y.item = b.item
               cross join (select count(distinct transaction_id) as n from baskets)
               group by a.item, b.item)
           where support >= 0.003""",
        "baskets",
    ),
    "basket_rules_fpgrowth": """
        with recursive baskets as (
            select distinct l_orderkey as t, p_name as i from lineitem join part on l_partkey = p_partkey),
        subsets as (
            select t, [i] as s, i as last_item from baskets
            union all
            select s.t, list_append(s.s, b.i), b.i from subsets s join baskets b on b.t = s.t and b.i > s.last_item),
        total as (select cast(count(distinct t) as double) as n from baskets),
        frequent as (
            select s, count(*) as c from subsets group by s having count(*) >= (select ceil(0.002 * n) from total)),
        rules as (
            select f.s, f.c, unnest(f.s) as consequent from frequent f where len(f.s) > 1),
        parts as (
            select s, c, consequent, list_filter(s, lambda x: x <> consequent) as antecedent from rules)
        select array_to_string(p.antecedent, ' + ') as antecedent, p.consequent,
               round(cast(p.c as double) / a.c, 9) as confidence, round(cast(p.c as double) / a.c * n / b.c, 9) as lift,
               round(p.c / n, 9) as support
        from parts p join frequent a on a.s = p.antecedent join frequent b on b.s = [p.consequent] cross join total
        where cast(p.c as double) / a.c >= 0.05""",
    "hr_clean": _with(
        """select statement_id, statement_type, cast(statement_valid_date as varchar) as statement_valid_date,
                  cast(case when statement_id % 5 = 0 then date '2100-12-31' else statement_valid_date + 365 end as varchar)
                      as statement_expired_date,
                  cast(employee_work_date as varchar) as employee_work_date, work_location, job_title, leader_code
           from statements""",
        "statements",
    ),
    "hr_position_map": _with("select statement_id, job_title, position from statements", "statements"),
    "hr_tenure": _with("select statement_id, statement_type, cast(tenure as double) as tenure from statements", "statements"),
    "hr_kpis": _with(
        """select '01/09/2001' as report_date, count(*) as employees,
                  count(*) filter (statement_type = 'TERMINATED') as leavers,
                  round_even(cast(count(*) filter (statement_type = 'TERMINATED') as double) / count(*) * 100, 2) as leaver_pct,
                  count(*) filter (statement_type = 'HIRED') as hires
           from statements""",
        "statements",
    ),
    "hr_status_counts": _with(
        _COUNT.format(keys="statement_type", counted="job_title", source="statements", where="true"), "statements"
    ),
    "hr_status_share": _with(
        _SHARE.format(key="statement_type", counted="job_title", source="statements", more=""), "statements"
    ),
    "hr_churn_by_year": _with(
        _COUNT.format(keys="valid_year", counted="statement_id", source="leavers", where="true"), "leavers"
    ),
    "hr_churn_by_year_share": _with(
        _SHARE.format(key="valid_year", counted="statement_id", source="leavers", more=""), "leavers"
    ),
    "hr_churn_by_location_share": _with(
        _SHARE.format(key="work_location", counted="statement_id", source="leavers", more=""), "leavers"
    ),
    "hr_churn_city": _with(
        """select statement_id, cast(statement_valid_date as varchar) as statement_valid_date, job_title, leader_code,
                  cast(tenure as double) as tenure from leavers where work_location = 'NATION_3'""",
        "leavers",
    ),
    "hr_churn_city_month": _with(
        _COUNT.format(keys="valid_month", counted="statement_id", source="leavers", where="work_location = 'NATION_3'"),
        "leavers",
    ),
    "hr_churn_city_position_share": _with(
        _SHARE.format(key="position", counted="statement_id", source="leavers", more="and work_location = 'NATION_3'"),
        "leavers",
    ),
    "hr_churn_job_counts": _with(
        """select job_title, count(*) as total from leavers
           where work_location = 'NATION_3' and position = 'Specialist' group by job_title""",
        "leavers",
    ),
    "hr_top_leaders": _with(
        """select leader_code, count(statement_id) as total_employees from leavers
           where work_location = 'NATION_3' and leader_code <> 'No Leader'
           group by leader_code order by 2 desc, 1 limit 10""",
        "leavers",
    ),
    "hr_hire_vs_churn": _with(
        """select h.valid_month, h.n as new_employees, c.n as churn_employees, h.n - c.n as difference
           from (select valid_month, count(statement_id) as n from statements where statement_type = 'HIRED' group by 1) h
           left join (select valid_month, count(statement_id) as n from leavers group by 1) c
             on h.valid_month = c.valid_month""",
        "leavers",
    ),
    "hr_tenure_share": _with(
        _SHARE.format(key="tenure", counted="statement_id", source="leavers", more="and tenure >= 0"), "leavers"
    ),
    "hr_tenure_by_position": _with(
        _COUNT.format(
            keys="tenure, position", counted="statement_id", source="leavers", where="tenure >= 0 and position is not null"
        ),
        "leavers",
    ),
    "hr_reason_share": _with(
        _SHARE.format(key="statement_name", counted="statement_id", source="leavers", more=""), "leavers"
    ),
    "text_extract_id": r"""
        select doc_id, nullif(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), '') as object_id
        from documents""",
    "text_standardize": f"select doc_id, {_CLEAN.format(_PLAIN)} as content_std from documents",
    "text_expand_abbrev": f"select doc_id, {_CLEAN.format(_abbreviations(_PLAIN))} as content_std from documents",
    "sentiment_score": _with(
        f"""select d.doc_id, coalesce({_BEST}, 2) as sentiment from documents d left join comment_scores using (doc_id)""",
        "comment_scores",
    ),
    "sentiment_argmax": _with(
        f"""select doc_id, round(exp(w0 - m) / s, 4) as negative, round(exp(w1 - m) / s, 4) as positive,
                   round(exp(w2 - m) / s, 4) as neutral, {_BEST} as sentiment
            from (select *, greatest(w0, w1, w2) as m, exp(w0 - greatest(w0, w1, w2)) + exp(w1 - greatest(w0, w1, w2))
                         + exp(w2 - greatest(w0, w1, w2)) as s from comment_scores)""",
        "comment_scores",
    ),
    "sentiment_word_list": _with(
        """select d.doc_id, case when coalesce(n, 0) = 0 and coalesce(p, 0) = 0 then 2 when n >= p then 0 else 1 end as sentiment
           from documents d left join (
               select doc_id, count(*) filter (word in ('der', 'die', 'und', 'of')) as n,
                      count(*) filter (word in ('the', 'and', 'la', 'de')) as p
               from comment_words group by doc_id) using (doc_id)""",
        "comment_words",
    ),
    "json_flatten_events": """
        select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as props_k from events""",
    "json_singleton_unwrap": _with(
        "select flight_number, cast(launch_date as varchar) as launch_date, rocket, payload_id, core_id from launch_document",
        "launch_document",
    ),
    "launch_outcome_text": _with(
        """select flight_number, core_id, landed || ' ' || landing as outcome, flights, grid_fins, reused, legs, landing_pad
           from launch_document""",
        "launch_document",
    ),
    "launch_enrich_dims": _with(
        """select l_orderkey as launch_id, l_linenumber as launch_seq, l_partkey as rocket_id, p_brand as booster_version,
                  site_name as launch_site, lon as longitude, lat as latitude, o_totalprice as payload_mass,
                  o_orderpriority as orbit, cast(c_custkey % 5 + 1 as double) as block, cast(c_custkey % 7 as int) as reuse_count,
                  c_name as serial
           from lineitem left join part on l_partkey = p_partkey
           left join site_geo on site_id = l_suppkey and l_suppkey % 11 <> 0
           left join orders on l_orderkey = o_orderkey
           left join customer on c_custkey = l_suppkey * 3 and (l_partkey + l_linenumber) % 5 <> 0""",
        "site_geo",
    ),
    "launch_renumber": _with(
        """select cast(launch_date as varchar) as launch_date, launch_id, launch_seq, part_key, supp_key, booster_version,
                  row_number() over (order by launch_date, launch_id, launch_seq, part_key, supp_key) as flight_number
           from launch where booster_version is distinct from 'Brand#1'""",
        "launch",
    ),
    "launch_impute_mean": _with(
        """select launch_id, launch_seq, part_key, supp_key,
                  coalesce(payload_mass, (select avg(payload_mass) from launch)) as payload_mass from launch""",
        "launch",
    ),
    "scraped_clean": """
        select l_orderkey as flight_no, l_linenumber as line_no, l_partkey as part_key, l_suppkey as supp_key,
               case l_partkey % 7 when 0 then null when 1 then 0.0 else l_quantity * 137 end as payload_mass,
               l_returnflag as launch_outcome, cast(cast(l_shipdate as date) as varchar) as launch_date
        from lineitem""",
    "wr_value_counts": _with(
        """select 'launch_site' as column_name, launch_site as value, count(*) as total from launch group by 2
           union all select 'orbit', orbit, count(*) from launch group by 2
           union all select 'outcome', outcome, count(*) from launch group by 2""",
        "launch",
    ),
    "wr_outcome_label": _with(
        """select launch_id, launch_seq, part_key, supp_key, outcome,
                  case when outcome in ('R F', 'N F') then 0 else 1 end as class from launch""",
        "launch",
    ),
    "wr_success_rate": _with("select avg(class) as success_rate from launch", "launch"),
    "profile_nulls": _with(
        " union all ".join(
            f"""select '{c}' as column_name, count(*) - count({c}) as null_count,
                       cast(count(*) - count({c}) as double) / count(*) * 100 as null_pct from employee_statement"""
            for c, _ in _STATEMENT_COLUMNS
        ),
        "employee_statement",
    ),
    "profile_columns": _with(
        " union all ".join(_PROFILE.format(c=c, t=t, most=50) for c, t in _STATEMENT_COLUMNS), "employee_statement"
    ),
    "profile_columns_wide": _with(
        " union all ".join(_PROFILE.format(c=c, t=t, most=150) for c, t in _STATEMENT_COLUMNS if t == "string"),
        "employee_statement",
    ),
    "values_numbered": _with(
        """select outcome, count(*) as total, row_number() over (order by count(*) desc, outcome) - 1 as position
           from launch group by outcome""",
        "launch",
    ),
    "sql_outcomes_by_site": _with(
        """select launch_site, outcome, count(*) as launches, sum(payload_mass) as payload_kg from launch
           where payload_mass is not null group by 1, 2""",
        "launch",
    ),
    "drop_all_null_columns": _with(_MESSY, "employee_statement"),
    "src_csv_roundtrip": """
        select doc_id, text, lang, source, n_chars, case when lang <> 'en' then source end as source_if_known from documents""",
    "src_csv_ranges": """
        select doc_id, text, lang, source, n_chars, case when lang <> 'en' then source end as source_if_known from documents""",
    "date_formats_inferred": f"""
        with read as (
            select o_orderpriority, day_text, cast(try_strptime(day_text, '%m/%d/%Y') as date) as m,
                   cast(try_strptime(day_text, '%d/%m/%Y') as date) as d
            from ({_DAY_TEXTS})),
        counted as (
            select o_orderpriority, count(day_text) as texts, count(m) as ms, count(d) as ds, coalesce(bool_or(m <> d), false) as apart
            from read group by 1)
        select o_orderpriority, case when greatest(ms, ds) = 0 then null when ms >= ds then 'M/d/yyyy' else 'd/M/yyyy' end as format,
               greatest(ms, ds) as fits, texts - greatest(ms, ds) as contradictions, ms = ds and ms > 0 and apart as ambiguous
        from counted""",
    "dates_in_inferred_format": f"""
        with read as (
            select *, cast(try_strptime(day_text, '%m/%d/%Y') as date) as m, cast(try_strptime(day_text, '%d/%m/%Y') as date) as d
            from ({_DAY_TEXTS}))
        select o_orderkey, o_orderpriority, day_text,
               cast(case when count(m) over p >= count(d) over p then m else d end as varchar) as day
        from read window p as (partition by o_orderpriority)""",
    "geo_zoom_clusters": _with(
        """select zoom, tile_x, tile_y, count(*) as records, cast(count(*) filter (where class = 1) as bigint) as successes,
                  case when zoom < 18 then count(distinct (x >> (17 - zoom), y >> (17 - zoom))) end as children
           from (select *, x >> (18 - zoom) as tile_x, y >> (18 - zoom) as tile_y
                 from (select class, cast(least(greatest(floor((lon + 180) / 360 * 262144), 0), 262143) as bigint) as x,
                              cast(least(greatest(floor((1 - ln(tan(phi) + 1 / cos(phi)) / pi()) / 2 * 262144), 0), 262143) as bigint)
                                  as y
                       from (select class, lon, radians(greatest(least(lat, 85.05112877980659), -85.05112877980659)) as phi
                             from launch_points where lat between -90 and 90 and lon between -180 and 180)),
                      (select cast(unnest(range(19)) as int) as zoom))
           group by 1, 2, 3""",
        "launch_points",
    ),
    "loyalty_visit_days_merged": _with(
        "select customer_id, count(distinct order_date) as total_days from sales where order_date is not null group by customer_id",
        "sales",
    ),
    "eda_distinct_sites": _with("select distinct launch_site from launch", "launch"),
    "eda_site_prefix": _with(
        """select launch_id, launch_seq, part_key, supp_key, cast(launch_date as varchar) as launch_date, payload_mass, orbit,
                  booster_version, launch_site, outcome, class
           from launch where launch_site ilike 'site_1%' order by launch_id, launch_seq, part_key, supp_key limit 5""",
        "launch",
    ),
    "eda_total_payload_customer": _with(
        """select sum(payload_mass) as total_payload_kg from launch join orders on launch_id = o_orderkey
           where 'CUST_' || cast(o_custkey % 50 as varchar) = 'CUST_7'""",
        "launch",
    ),
    "eda_avg_payload_version": _with(
        "select avg(payload_mass) as avg_payload_kg from launch where booster_version ilike 'brand#12'", "launch"
    ),
    "eda_first_success_date": _with(
        "select cast(min(launch_date) as varchar) as first_date from launch where outcome ilike 'a o'", "launch"
    ),
    "eda_booster_payload_range": _with(
        "select booster_version from launch where outcome = 'A F' and payload_mass between 20 and 30", "launch"
    ),
    "eda_outcome_counts": _with(
        "select outcome, count(*) as total_count from launch where launch_date is not null group by outcome", "launch"
    ),
    "eda_max_payload_boosters": _with(
        "select booster_version from launch where payload_mass = (select max(payload_mass) from launch)", "launch"
    ),
    "eda_failures_by_month": _with(
        """select monthname(launch_date) as month_name, booster_version, launch_site from launch
           where outcome = 'R F' and year(launch_date) = 1998""",
        "launch",
    ),
    "eda_outcome_rank_period": _with(
        """select outcome, count(*) as launches from launch
           where launch_date between date '1996-06-04' and date '1999-03-20' group by outcome order by 2 desc""",
        "launch",
    ),
    "eda_ctas_not_null": _with(
        """select statement_id, statement_type, statement_name, cast(statement_valid_date as varchar) as statement_valid_date,
                  cast(employee_work_date as varchar) as employee_work_date, work_location, job_title, leader_code
           from employee_statement where employee_work_date is not null""",
        "employee_statement",
    ),
    "viz_success_by_orbit": _with(
        "select orbit, avg(class) as success_rate from launch where orbit is not null group by orbit", "launch"
    ),
    "viz_success_by_year": _with(
        "select cast(year(launch_date) as int) as launch_year, avg(class) as success_rate from launch group by 1", "launch"
    ),
    "viz_scatter_bins": _with(
        """select cast(floor(payload_mass / 5) * 5 as double) as payload_mass_from, launch_site, class, count(*) as points
           from launch where payload_mass is not null group by 1, 2, 3""",
        "launch",
    ),
    "dash_payload_bounds": _with(
        "select min(payload_mass) as min_payload, max(payload_mass) as max_payload from launch", "launch"
    ),
    "dash_success_by_site": _with(
        """select launch_site, cast(sum(class) as bigint) as successes,
                  round_even(cast(sum(class) as double) / (sum(sum(class)) over ()) * 100, 2) as share_pct
           from launch group by launch_site""",
        "launch",
    ),
    "dash_site_outcomes": _with(
        "select launch_site, class, count(*) as class_count from launch where launch_site = 'SITE_2' group by 1, 2", "launch"
    ),
    "dash_payload_scatter_all": _with(
        "select launch_site, payload_mass, class, booster_version from launch where payload_mass between 10 and 40", "launch"
    ),
    "dash_payload_scatter": _with(
        """select launch_site, payload_mass, class, booster_version from launch
           where payload_mass between 10 and 40 and launch_site = 'SITE_2'""",
        "launch",
    ),
    "geo_sites": _with(
        "select site_name, arg_min(lat, launch_id) as lat, arg_min(lon, launch_id) as lon from launch_points group by site_name",
        "launch_points",
    ),
    "geo_marker_colors": _with(
        """select launch_id, launch_seq, part_key, supp_key, site_name, lat, lon,
                  case when class = 1 then 'green' else 'red' end as marker_color from launch_points""",
        "launch_points",
    ),
    "geo_marker_clusters": _with(
        """select cast(floor(lat / 10) as bigint) as cell_lat, cast(floor(lon / 10) as bigint) as cell_lon, count(*) as records,
                  avg(class) as success_rate from launch_points group by 1, 2""",
        "launch_points",
    ),
    "geo_nearest_poi": _with(
        f"""select site_id, site_name, lat, lon, poi_id, poi_name, poi_lat, poi_lon, round(km, 6) as km,
                   printf('%s %10.2f KM', poi_name, km) as label
            from (select *, {_KM} as km from (select *, {_HAVERSINE} as h from site_geo cross join poi_geo))
            qualify row_number() over (partition by site_id order by km, poi_id) = 1""",
        "site_geo", "poi_geo",
    ),
    "html_title_extract": f"""
        select page_id, {_text_of("nullif(regexp_extract(html, '(?is)<title(?:\\s[^>]*)?>(.*?)</title\\s*>', 1), '')")} as title
        from pages""",
    "html_table_rows": f"""
        select page_id, cast(row_no as int) as row_no,
               {_text_of("regexp_extract(row_html, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1)")} as link_text
        from (select page_id, generate_subscripts({_LINKS}, 1) - 1 as row_no, unnest({_LINKS}) as row_html from pages)""",
    "revenue_clean": _with("select row_id, cast(d as varchar) as d, revenue from revenue_rows", "revenue_rows"),
    "revenue_last_rows": _with(
        """select row_id, cast(d as varchar) as d, revenue from revenue_rows order by d desc, row_id desc limit 5""",
        "revenue_rows",
    ),
    "series_price_revenue": _with(
        """select 'share_price' as series, cast(cast(ts as date) as varchar) as d, max(value) as value from events
           where event_type = 'purchase' and cast(ts as date) <= date '2024-01-20' group by 2
           union all
           select 'revenue', cast(d as varchar), sum(revenue) from revenue_rows where d <= date '2001-04-30' group by 2""",
        "revenue_rows",
    ),
    "features_one_hot": _with(
        "select launch_id, launch_seq, part_key, supp_key, payload_mass, cast(class as double) as class, "
        + ", ".join(
            f"cast(orbit = '{v}' as int)::double as orbit_{v}"
            for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + ", "
        + ", ".join(f"cast(launch_site = 'SITE_{i}' as int)::double as launch_site_SITE_{i}" for i in range(4))
        + " from launch",
        "launch",
    ),
    "features_standardize": _with(
        """select vec_id, cast(e - 1 as int) as entry,
                  round(coalesce((x - avg(x) over (partition by e)) / nullif(stddev_pop(x) over (partition by e), 0), 0), 6) as z
           from entries""",
        "entries",
    ),
    "ml_train_test_split": _with(
        "select vec_id, label, case when is_test then 'test' else 'train' end as part from split", "split"
    ),
    "ml_linear_figures": """
        with v as (
            select vec_id, embedding::double[] as x, case when label >= 5 then 1.0::double else -1.0::double end as y,
                   cast('0x' || substr(md5('3:' || cast(vec_id as varchar)), 1, 8) as bigint) % 10 as fold,
                   list_dot_product(embedding::double[], [((7 * i) % 11 - 5) / 10.0::double for i in range(64)]) + 0.1::double as margin
            from embeddings),
        each as (
            select loss, held, x, y, margin, y * margin as z, fold <> held as outside
            from v, (values ('hinge'), ('logistic')) l(loss), range(10) r(held)),
        sloped as (
            select *, case when loss = 'hinge' then greatest(0.0::double, 1 - z)
                           else greatest(0.0::double, -z) + ln(1 + exp(-abs(z))) end as part,
                   -y * case when loss = 'hinge' then (z < 1)::int::double else 1 / (1 + exp(z)) end as slope
            from each),
        figures as (
            select loss, held, 'loss' as figure, sum(part) filter (outside) as value from sloped group by all
            union all select loss, held, 'rows', count(*) filter (outside) from sloped group by all
            union all select loss, held, 'hits', count(*) filter (not outside and (margin > 0) = (y > 0)) from sloped group by all
            union all select loss, held, 'offset', sum(slope) filter (outside) from sloped group by all
            union all
            select loss, held, 'w' || (e - 1), sum(slope * xi) filter (outside)
            from (select loss, held, outside, slope, unnest(x) as xi, generate_subscripts(x, 1) as e from sloped) group by all)
        select loss, cast(held as int) as fold, figure, round(coalesce(value, 0)::double, 6) as value from figures""",
    "ml_knn_classify": _with("select id, p, k, label, predicted from predictions", "predictions"),
    "ml_knn_all": _with(
        """select id, neighbour, label, round(distance, 9) as distance, place from (
               select q.vec_id as id, t.vec_id as neighbour, t.label, distance,
                      cast(row_number() over (partition by q.vec_id order by distance, t.vec_id) as int) as place
               from (select e.vec_id, e.embedding::double[] as x from embeddings e join split s on s.vec_id = e.vec_id where is_test) q,
                    (select e.vec_id, e.label, e.embedding::double[] as y
                     from embeddings e join split s on s.vec_id = e.vec_id where not is_test) t,
                    lateral (select list_distance(x, y) as distance) d)
           where place <= 5""",
        "split",
    ),
    "ml_cv_knn": _with("select p, k, cv_accuracy from fold_scores", "fold_scores"),
    "ml_confusion": _with(
        """select label, predicted, count(*) as n from predictions
           where (p, k) in (select (p, k) from fold_scores order by cv_accuracy desc, p, k limit 1) group by 1, 2""",
        "predictions",
        "fold_scores",
    ),
    "ml_best_neighbours": _with(
        """select p * 100 + k as position, 'p=' || p || ' k=' || k as model, score
           from (select p, k, round(avg(case when label = predicted then 1.0::double else 0 end), 9) as score
                 from predictions group by p, k)
           order by score desc, position limit 1""",
        "predictions",
    ),
}
