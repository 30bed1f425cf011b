-- Star/snowflake join on the TPC-H-like tables, same shape as
-- atencion_detalle: lineitem is the fact; part and supplier are dimensions,
-- nation hangs off supplier, and two small status catalogues decode the
-- coded flags.
with return_status (rf_code, rf_desc) as (
  values ('A', 'ACCEPTED'), ('N', 'NONE'), ('R', 'RETURNED')
), line_status (ls_code, ls_desc) as (
  values ('F', 'FULFILLED'), ('O', 'OPEN')
)
select f.l_orderkey,
       f.l_linenumber,
       f.l_shipdate   as ship_date,
       p.p_partkey,
       p.p_name,
       p.p_brand,
       p.p_type,
       s.s_suppkey,
       s.s_name,
       n.n_name       as supplier_nation,
       rs.rf_desc     as return_status,
       ls.ls_desc     as line_status,
       f.l_quantity
from lineitem f
join part p           on p.p_partkey = f.l_partkey
join supplier s       on s.s_suppkey = f.l_suppkey
join nation n         on n.n_nationkey = s.s_nationkey
join return_status rs on rs.rf_code = f.l_returnflag
join line_status ls   on ls.ls_code = f.l_linestatus
