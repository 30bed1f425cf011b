-- Natural-key check on lineitem: (l_partkey, l_shipdate) groups seen more
-- than once.
select l_partkey, l_shipdate, count(*) as conteo
from lineitem
group by l_partkey, l_shipdate
having count(*) > 1
