"""DataFrame -> DataFrame operators. All are lazy: none runs an action or registers a view."""
