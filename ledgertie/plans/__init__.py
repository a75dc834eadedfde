"""Named queries over the bindings and the SQL each one must agree with."""
