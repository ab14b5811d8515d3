"""Every operator as a query on the test tables, with the SQL it must agree with."""
