"""Noisy form text made from the TPC-H-like tables. The expressions are plain SQL that Spark and DuckDB read alike."""

#: Times as a recogniser might give them, from lineitem.
TIME = """case l_linenumber % 8
 when 0 then cast(l_orderkey % 26 as string) || ':' || lpad(cast(l_partkey % 64 as string), 2, '0')
 when 1 then cast(l_orderkey % 24 as string) || '.' || lpad(cast(l_partkey % 60 as string), 2, '0')
 when 2 then lpad(cast(l_orderkey % 24 as string), 2, '0') || lpad(cast(l_partkey % 60 as string), 2, '0')
 when 3 then ',' || lpad(cast(l_orderkey % 24 as string), 2, '0') || '1' || lpad(cast(l_partkey % 60 as string), 2, '0')
 when 4 then '(' || cast(l_orderkey % 24 as string) || '.' || lpad(cast(l_partkey % 70 as string), 2, '0') || '.'
 when 5 then cast(l_orderkey % 14 as string) || ':' || lpad(cast(l_partkey % 60 as string), 2, '0') || ' pm'
 when 6 then cast(l_orderkey % 12 as string) || '-' || cast(l_partkey % 60 as string) || 'a.m.'
 else 'no time' end"""

_CENTS = "cast(l_partkey * 37 % 9000000 + l_suppkey as bigint)"
#: Amounts with 2 decimals and noise, from lineitem.
AMOUNT = f"""case l_linenumber % 8
 when 0 then '$' || cast({_CENTS} // 100 as string) || '.' || lpad(cast({_CENTS} % 100 as string), 2, '0')
 when 1 then '(' || cast({_CENTS} // 100 as string) || '.' || lpad(cast({_CENTS} % 100 as string), 2, '0') || ')'
 when 2 then cast({_CENTS} // 100 as string) || ',' || lpad(cast({_CENTS} % 100 as string), 2, '0')
 when 3 then ',' || cast({_CENTS} // 100 as string) || '..' || lpad(cast({_CENTS} % 100 as string), 2, '0') || '.'
 when 4 then '--O' || cast({_CENTS} // 100 as string) || '.' || lpad(cast({_CENTS} % 1000 as string), 3, '0')
 when 5 then '1,' || lpad(cast({_CENTS} % 1000 as string), 3, '0') || ',' || lpad(cast(l_suppkey % 1000 as string), 3, '0') || '.5'
 when 6 then '-0.00' || cast(l_suppkey % 10 as string)
 else 'n/a' end"""

#: Dates with several separators and faults, from orders.
DATE = """cast(extract(month from o_orderdate) + case when o_orderkey % 17 = 0 then 12 else 0 end as string)
 || case o_orderkey % 3 when 0 then '/' when 1 then '-' else '.' end || cast(extract(day from o_orderdate) as string)
 || case o_orderkey % 3 when 0 then '/' when 1 then '-' else '.' end
 || case when o_orderkey % 2 = 0 then cast(extract(year from o_orderdate) as string) else lpad(cast(o_orderkey % 100 as string), 2, '0') end"""


def for_spark(sql: str) -> str:
    return sql.replace("//", "div")


#: Field names of a form, from part and lineitem.
FIELD = """case l_linenumber % 9 when 0 then 'employee_name' when 1 then 'in_am' when 2 then 'out_am' when 3 then 'lunch' when 4 then 'in_pm'
 when 5 then 'out_pm' when 6 then 'total_hours' when 7 then 'signature' else 'date' end || case when l_partkey % 10 = 0 then '' else '_r' || cast(l_partkey % 12 as string) end"""
PAGE = "'pages/p' || cast(l_suppkey as string) || '.png'"
KEY = """case l_linenumber % 7 when 0 then 'row' || cast(l_partkey % 9 as string) || '_clock_in_am' when 1 then 'x_Clock_Out_PM' when 2 then 'week_total_hours'
 when 3 then 'employee_name' when 4 then 'lunch_r2' when 5 then 'signature' else 'clock_in_note' end"""
