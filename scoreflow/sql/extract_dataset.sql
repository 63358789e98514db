-- One date slice of a catalog table (customer feature store).
SELECT *
FROM IDENTIFIER(:source_table)
WHERE data_dt = :data_dt
