"""DataFrame operators of the splicing assay."""
