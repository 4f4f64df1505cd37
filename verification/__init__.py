"""The registered queries and the SQL texts they are compared with."""
