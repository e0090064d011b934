"""DataFrame -> DataFrame operators of the silver, gate and gold layers."""
