-- Customer snapshot projection for one date slice.
SELECT
    customer_id,
    snapshot_ts,
    credit_score,
    delinquency_risk
FROM IDENTIFIER(:source_table)
WHERE data_dt = :data_dt
