"""Writers: conform to the declared schema, layered full refresh, JDBC."""
