-- Pre-load statement run in the target database before a slice is loaded.
-- JDBC '?' markers are bound in order from the statement's parameter list.
DELETE FROM TARGET.CUSTOMER_SNAPSHOT WHERE DATA_DT = ?
