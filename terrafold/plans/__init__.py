"""Job plans: catalog DDL, the two products' end-to-end flows, and the
registered queries over the supplied tables."""
