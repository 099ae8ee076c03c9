"""dossierflow: profile pages in, analysable career tables out, as Spark jobs."""
