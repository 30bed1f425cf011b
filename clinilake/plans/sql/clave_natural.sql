-- Natural-key check of atencion_detalle: (PACDOC, FECHA_ATENCION) groups
-- seen more than once.  An empty result means the pair is a valid key.
select PACDOC, FECHA_ATENCION, count(*) as conteo
from atencion_detalle
group by PACDOC, FECHA_ATENCION
having count(*) > 1;
